"""SQL entry (temp views) and the batch job over the CSV fixtures."""

from pyspark.sql import functions as F

from conftest import FIXTURES, SMOKE_DIR
from ledgerline.plans.catalog import QUERIES, Retail
from ledgerline.plans.job import run_batch_job
from ledgerline.plans.sql_views import register_retail_views


def _same(a, b):
    return sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_views_hold_the_frames(spark):
    r = Retail(spark, SMOKE_DIR)
    register_retail_views(spark, r.sales(), r.customers(), r.products())
    by_city = spark.sql(
        "SELECT city, CAST(SUM(revenue) AS DOUBLE) AS total_revenue, COUNT(*) AS total_transactions "
        "FROM sales JOIN customers USING (customer_id) GROUP BY city"
    )
    assert _same(by_city, QUERIES["revenue_by_city"](spark, SMOKE_DIR))


def test_batch_job_on_fixtures(spark, tmp_path):
    rep = run_batch_job(
        spark,
        f"{FIXTURES}/sales.csv",
        f"{FIXTURES}/customers.csv",
        f"{FIXTURES}/products.csv",
        str(tmp_path),
    )
    assert rep.bronze == {"sales": 12, "customers": 3, "products": 2}
    assert rep.silver["sales"] == 8
    assert rep.rejected == {"malformed": 2, "null_key": 1, "non_positive": 1}
    assert rep.orphans == {"orphan_customers": 1, "orphan_products": 1}
    assert rep.duplicate_keys == {"duplicate_customers": 1, "duplicate_products": 0}
    # every day with sales is below the default 1000 threshold
    assert rep.low_sales_days == spark.read.parquet(f"{tmp_path}/gold/daily_revenue").count()
    city = spark.read.parquet(f"{tmp_path}/gold/revenue_by_city")
    assert {r["city"] for r in city.collect()} == {"Pune", "Delhi"}


def test_job_command_line(spark, tmp_path, capsys):
    import json

    from ledgerline.plans.job import main

    rc = main(
        [
            "--sales", f"{FIXTURES}/sales.csv",
            "--customers", f"{FIXTURES}/customers.csv",
            "--products", f"{FIXTURES}/products.csv",
            "--out", str(tmp_path),
            "--price-floor", "1.00",
            "--alert-threshold", "10",
        ]
    )
    assert rc == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    # T3 (0.10) and TA (0.11) now fall under the price floor
    assert report["silver"]["sales"] == 6
    assert report["rejected"]["non_positive"] == 3
    assert report["low_sales_days"] == 2  # 03-31 (5.00) and the undated day (6.00); 01-01 is 40.40
    assert report["gold"]["revenue_by_city"] == 1  # T3, the only Delhi sale, is under the floor


def test_observed_rejects_equal_the_reject_report(spark, tmp_path):
    from decimal import Decimal

    from ledgerline.operators import quality
    from ledgerline.params import RetailParams
    from ledgerline.plans import lakehouse
    from ledgerline.sources import read_sales_csv

    raw = read_sales_csv(spark, f"{FIXTURES}/sales.csv")
    for floor in ("0", "1.00", "10.00"):
        params = RetailParams(price_floor=Decimal(floor))
        written, observed = lakehouse.write_silver_sales_counting_rejects(raw, f"{tmp_path}/{floor}", params)
        report = {r["reason"]: r["n"] for r in quality.rejected_rows(raw, params).collect()}
        assert observed == report
        assert written == quality.clean_sales(raw, params).count()


def test_entry_point_registers_the_retail_queries():
    import __spark_entry__ as contract

    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
