"""Cross-query invariants on the driver data (property-style checks)."""

from decimal import Decimal

import pytest

from conftest import SMOKE_DIR
import retail_contract as contract

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q():
    return contract.queries()


def _total(spark, q, key, col):
    return sum(Decimal(str(r[col])) for r in q[key](spark, SF).collect() if r[col] is not None)


def test_totals_reconcile(spark, q):
    total = Decimal(str(q["total_sales"](spark, SF).first()["total_sales"]))
    # no orphans and no duplicate dimension keys in the driver data, so every
    # split of the fact adds back up to the fact total
    assert _total(spark, q, "sales_by_city", "total_sales") == total
    assert _total(spark, q, "sales_by_category", "total_sales") == total
    assert _total(spark, q, "sales_by_brand", "total_sales") == total
    assert _total(spark, q, "monthly_trend", "monthly_revenue") == total
    assert _total(spark, q, "gold_monthly_trend", "monthly_revenue") == total
    assert _total(spark, q, "revenue_by_city", "total_revenue") == total
    assert _total(spark, q, "product_revenue", "revenue") == total
    assert _total(spark, q, "daily_revenue", "daily_revenue") == total
    assert _total(spark, q, "segment_summary", "total_sales") == total
    assert Decimal(str(q["executive_overview"](spark, SF).first()["total_sales"])) == total


def test_counts_reconcile(spark, q):
    n_clean = q["clean_sales"](spark, SF).count()
    assert sum(r["total_transactions"] for r in q["gold_revenue_by_city"](spark, SF).collect()) == n_clean
    raw = {r["table_name"]: r["n_rows"] for r in q["bronze_profile"](spark, SF).collect()}
    rejected = sum(r["n"] for r in q["rejected_rows"](spark, SF).collect())
    floor_clean = q["clean_sales"](spark, SF).filter("price > 5000").count()
    assert floor_clean + rejected == raw["sales"]  # the reject report uses a 5,000 price floor
    ov = q["executive_overview"](spark, SF).first()
    assert ov["customer_count"] == q["customer_count"](spark, SF).first()[0]
    assert ov["average_order_value"] == q["average_order_value"](spark, SF).first()[0]
    assert ov["sales_growth"] == q["sales_growth_mtd"](spark, SF).first()["growth"]


def test_segment_column_is_the_segment_total(spark, q):
    rows = q["revenue_by_segment"](spark, SF).collect()
    per_seg = {}
    for r in rows:
        per_seg[r["segment"]] = per_seg.get(r["segment"], Decimal(0)) + Decimal(str(r["revenue"]))
    for r in rows:
        assert Decimal(str(r["segment_revenue"])) == per_seg[r["segment"]]


def test_spikes_are_windows(spark, q):
    windows = set(map(tuple, q["windowed_demand"](spark, SF).collect()))
    spikes = set(map(tuple, q["demand_spikes"](spark, SF).collect()))
    assert spikes and spikes <= windows
    stream = set(map(tuple, q["stream_windowed_demand"](spark, SF).collect()))
    assert stream <= windows and len(windows) - len(stream) <= 5


def test_top_k_agree_with_full_rankings(spark, q):
    full = sorted(q["product_revenue"](spark, SF).collect(), key=lambda r: (-r["revenue"], r["product_id"]))
    top = q["top10_products"](spark, SF).collect()
    assert [tuple(r) for r in top] == [tuple(r) for r in full[:10]]
    cats = q["sales_by_category"](spark, SF).collect()
    best = sorted(cats, key=lambda r: (-r["total_sales"], r["category"]))[0]["category"]
    assert q["top_category"](spark, SF).first()["top_category"] == best
