"""Physical-plan assertions: no Python on the data path, pruned scans, top-k fusion."""

import pytest

from conftest import SMOKE_DIR
import retail_contract as contract

# Keys that write (lakehouse, stream) are exercised in their own tests.
SIDE_EFFECT_KEYS = {
    "silver_store_sales",
    "stream_windowed_demand",
    "stream_demand_spikes",
    "csv_stream_windowed_demand",
}
PURE_KEYS = sorted(set(contract.queries()) - SIDE_EFFECT_KEYS)


def _plan(df):
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


@pytest.mark.parametrize("key", PURE_KEYS)
def test_no_python_on_the_data_path(spark, key):
    plan = _plan(contract.queries()[key](spark, SMOKE_DIR))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonRDD", "FlatMapGroupsInPandas", "MapInPandas"):
        assert marker not in plan, (key, marker)


@pytest.mark.parametrize("key", ["top10_products", "top5_products", "top_category"])
def test_top_k_is_fused(spark, key):
    df = contract.queries()[key](spark, SMOKE_DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def _direct(spark):
    from ledgerline.plans.catalog import Retail

    return Retail(spark, SMOKE_DIR, materialize=False)


def test_scans_read_only_needed_columns(spark):
    from ledgerline.operators import marts

    r = _direct(spark)
    plan = _plan(marts.revenue_by_city(r.sales(), r.customers()))
    # lineitem: store_id is not needed, so even l_suppkey is pruned
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in plan
    assert "c_acctbal" not in plan
    assert "o_totalprice" not in plan


def test_inferred_not_null_filters_reach_the_scan(spark):
    r = _direct(spark)
    plan = _plan(r.enriched())
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln]
    assert any("lineitem" in ln and "IsNotNull(l_orderkey)" in ln for ln in pushed)
    assert any("orders" in ln and "IsNotNull(o_orderkey)" in ln for ln in pushed)


def test_spike_baseline_is_a_scalar_subquery_not_a_cross_join(spark):
    df = contract.queries()["demand_spikes"](spark, SMOKE_DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Subquery" in plan


def test_growth_by_month_has_no_global_window(spark):
    plan = _plan(contract.queries()["sales_growth_by_month"](spark, SMOKE_DIR))
    assert "Window" not in plan
    assert "SinglePartition" not in plan


def test_spike_baseline_reuses_the_window_aggregation(spark):
    df = contract.queries()["demand_spikes"](spark, SMOKE_DIR)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_layered_queries_read_pruned_written_tables(spark):
    plan = _plan(contract.queries()["gold_revenue_by_city"](spark, SMOKE_DIR))
    assert "ReadSchema: struct<city:string,total_revenue:double" in plan
    assert "Exchange" not in plan
    assert "lineitem" not in plan  # the star join is not recomputed


def test_store_query_prunes_partitions(spark):
    plan = _plan(contract.queries()["silver_store_sales"](spark, SMOKE_DIR))
    assert "PartitionFilters: [isnotnull(store_id" in plan and "= S3)" in plan
