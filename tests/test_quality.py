"""Cleaning, rejection and validation rules on hand-made CSV rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import FIXTURES
from ledgerline.operators import quality
from ledgerline.params import RetailParams
from ledgerline.schemas import CORRUPT_RECORD, FACT_COLUMNS
from ledgerline.sources import read_customers_csv, read_sales_csv


def _by_id(df):
    return {r["transaction_id"]: r for r in df.collect()}


def test_clean_keeps_exactly_the_valid_rows(retail_csv):
    clean = quality.clean_sales(retail_csv["sales"])
    assert tuple(clean.columns) == FACT_COLUMNS
    rows = clean.collect()
    ids = sorted(r["transaction_id"] for r in rows)
    assert ids == ["T1", "T1", "T3", "T7", "T8", "T9", "TA", "TB"]


def test_revenue_is_exact_decimal(retail_csv):
    rows = _by_id(quality.clean_sales(retail_csv["sales"]))
    assert rows["T1"]["revenue"] == Decimal("20.20")
    # 0.105 is rounded to the 2-dp money type at read time
    assert rows["TA"]["price"] == Decimal("0.11")
    assert rows["TA"]["revenue"] == Decimal("0.11")


def test_bad_timestamp_is_null_not_an_error(spark, retail_csv):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rows = _by_id(quality.clean_sales(retail_csv["sales"]))
    assert rows["T3"]["timestamp"] is None
    assert rows["T3"]["store_id"] is None
    assert rows["T7"]["timestamp"] is None
    assert rows["TB"]["timestamp"] is None  # short line missing only its timestamp
    assert rows["T9"]["timestamp"] is not None


def test_ids_trimmed_and_store_kept_as_string(retail_csv):
    rows = _by_id(quality.clean_sales(retail_csv["sales"]))
    assert "T8" in rows
    assert rows["T8"]["store_id"] == "01"


def test_reject_reasons_and_precedence(retail_csv):
    counts = {r["reason"]: r["n"] for r in quality.rejected_rows(retail_csv["sales"]).collect()}
    assert counts == {"malformed": 2, "null_key": 1, "non_positive": 1}
    recs = quality.rejected_records(retail_csv["sales"]).collect()
    malformed = [r for r in recs if r["reason"] == "malformed"]
    assert all(r[CORRUPT_RECORD] for r in malformed)  # raw line kept for audit


def test_clean_plus_rejected_is_input(retail_csv):
    raw = retail_csv["sales"]
    n_raw = raw.count()
    n_clean = quality.clean_sales(raw).count()
    n_rej = quality.rejected_records(raw).count()
    assert n_clean + n_rej == n_raw == 12


def test_price_floor_parameter(retail_csv):
    params = RetailParams(price_floor=Decimal("10.00"))
    clean = quality.clean_sales(retail_csv["sales"], params)
    assert sorted(r["transaction_id"] for r in clean.collect()) == ["T1", "T1", "T9"]
    counts = {r["reason"]: r["n"] for r in quality.rejected_rows(retail_csv["sales"], params).collect()}
    # T3, T6, T7, T8, TA fail the floor; TB is a short line, so "malformed" wins
    assert counts == {"malformed": 3, "null_key": 1, "non_positive": 5}


def test_orphans_and_duplicates(retail_csv):
    clean = quality.clean_sales(retail_csv["sales"])
    oc = {r["customer_id"]: r["n_sales"] for r in quality.orphan_keys(clean, retail_csv["customers"], "customer_id").collect()}
    op = {r["product_id"]: r["n_sales"] for r in quality.orphan_keys(clean, retail_csv["products"], "product_id").collect()}
    assert oc == {"C9": 1}
    assert op == {"P9": 1}
    dup = {r["customer_id"]: r["n"] for r in quality.duplicate_keys(retail_csv["customers"], "customer_id").collect()}
    assert dup == {"C2": 2}
    assert quality.duplicate_keys(retail_csv["products"], "product_id").count() == 0


def test_quoted_comma_kept(retail_csv):
    names = {r["customer_id"]: r["name"] for r in retail_csv["customers"].collect()}
    assert names["C1"] == "Rao, A"


def test_swapped_header_fails(spark):
    df = read_customers_csv(spark, f"{FIXTURES}/customers_swapped.csv")
    with pytest.raises(Exception):
        df.collect()


def test_required_columns_and_emptiness(spark, retail_csv):
    quality.check_frame(retail_csv["sales"], "sales", ["transaction_id", "price", "quantity"])
    with pytest.raises(ValueError, match="no column named"):
        quality.require_columns(retail_csv["products"], "products", ["product_id", "colour"])
    empty = read_sales_csv(spark, f"{FIXTURES}/sales_empty.csv")
    with pytest.raises(ValueError, match="no rows"):
        quality.require_rows(empty, "sales")


def test_table_profile(retail_csv):
    prof = quality.table_profile(
        {
            "sales": (retail_csv["sales"], ("transaction_id", "customer_id", "product_id")),
            "customers": (retail_csv["customers"], ("customer_id",)),
        }
    )
    got = {r["table_name"]: (r["n_rows"], r["n_null_keys"]) for r in prof.collect()}
    assert got == {"sales": (12, 1), "customers": (3, 0)}


def test_cleaning_has_no_python_udf(retail_csv):
    plan = quality.clean_sales(retail_csv["sales"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
