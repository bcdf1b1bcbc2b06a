"""Every registered query against its independent DuckDB statement."""

import pytest

from conftest import SMOKE_DIR
from oracle_check import compare, duck

import retail_contract as contract
from __spark_entry__ import entry

KEYS = sorted(contract.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


def test_every_query_has_an_oracle():
    assert set(contract.oracle_sql()) == set(contract.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, SMOKE_DIR, contract.queries()[key], contract.oracle_sql()[key])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["city", "total_revenue", "total_transactions"]
    assert df.count() > 0


SF001 = "/root/testdata/sf0.01"


def test_documented_values_at_sf001(spark):
    q = contract.queries()
    city = {r["city"]: r for r in q["gold_revenue_by_city"](spark, SF001).collect()}
    n0 = city["NATION_0"]
    assert (n0["total_revenue"], n0["total_transactions"], n0["avg_order_value"]) == (
        2953913172.71, 2164, 1365024.57)
    assert q["average_order_value"](spark, SF001).first()[0] == 5490834.38
    mtd = q["sales_growth_mtd"](spark, SF001).first()
    assert (mtd["this_month"], mtd["last_month"], mtd["growth"]) == (10716584.54, 50986517.23, -0.789815)
    assert q["top_category"](spark, SF001).first()[0] == "MEDIUM"
    m = {r["month"]: r for r in q["sales_growth_by_month"](spark, SF001).collect()}
    assert len(m) == 80
    assert (m["1995-02"]["revenue"], m["1995-02"]["growth"]) == (973648065.92, -0.093856)
    seg = {r["segment"]: r for r in q["gold_customer_segments"](spark, SF001).collect()}
    a = seg["AUTOMOBILE"]
    assert (a["total_revenue"], a["unique_customers"], a["avg_spend"]) == (15619743852.24, 298, 1346645.73)
    assert q["high_value_sales"](spark, SF001).count() == 6905
    assert q["low_sales_days"](spark, SF001).count() == 95
