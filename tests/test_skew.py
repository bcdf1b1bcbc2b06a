"""Hot keys: one customer holds a third of all sales.

Joins are forced to sort-merge (as they are when the dimension is too big to
broadcast) and AQE's skew handling is given small thresholds, so the test
shows the hot partition being split while the result stays whole and exact.
"""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import marts, quality

FORCE_SMJ = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def smj_only(spark):
    old = {k: spark.conf.get(k, None) for k in FORCE_SMJ}
    for k, v in FORCE_SMJ.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed(spark, n=30000):
    sales = spark.range(n).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("transaction_id"),
        # a third of all rows belong to customer C0
        F.when(F.col("id") % 3 == 0, F.lit("C0"))
        .otherwise(F.concat(F.lit("C"), (F.col("id") % 997 + 1).cast("string")))
        .alias("customer_id"),
        F.concat(F.lit("P"), (F.col("id") % 50).cast("string")).alias("product_id"),
        F.lit("S1").alias("store_id"),
        (F.col("id") % 5 + 1).cast("int").alias("quantity"),
        F.lit(Decimal("2.50")).cast("decimal(12,2)").alias("price"),
        F.lit("2024-01-01 00:00:00").alias("timestamp"),
    )
    customers = spark.range(998).select(
        F.concat(F.lit("C"), F.col("id").cast("string")).alias("customer_id"),
        F.lit("n").alias("name"),
        F.concat(F.lit("city"), (F.col("id") % 7).cast("string")).alias("city"),
        F.lit("seg").alias("segment"),
    )
    return quality.clean_sales(sales), customers


def test_hot_customer_is_split_and_totals_stay_whole(smj_only):
    spark = smj_only
    sales, customers = _skewed(spark)
    by_city = marts.revenue_by_city(sales, customers)
    rows = by_city.collect()
    plan = by_city._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    # Sales are summed per customer first, so the join sees one row per key and nothing is skewed.
    assert "skew=true" not in plan
    per_customer = sales.groupBy("customer_id").count()
    assert per_customer.agg(F.max("count")).first()[0] == 10000 and per_customer.count() == 998
    # nothing dropped: every sale has a known customer
    assert sum(r["total_transactions"] for r in rows) == 30000
    total = sum((r["total_revenue"] for r in rows), Decimal(0))
    assert total == sales.agg(F.sum("revenue")).first()[0]


def test_the_star_join_splits_a_hot_customer(smj_only):
    """The enriched join keeps every sale, so there adaptive execution splits the hot partition."""
    spark = smj_only
    sales, customers = _skewed(spark)
    products = spark.range(50).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"),
        F.lit("c").alias("category"),
        F.lit("b").alias("brand"),
    )
    enriched = marts.enrich(sales, customers, products)
    rows = enriched.collect()
    plan = enriched._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "skew=true" in plan
    assert len(rows) == 30000
    assert sum(r["customer_id"] == "C0" for r in rows) == 10000


def test_the_star_join_and_the_silver_write_shuffle_no_revenue(smj_only):
    """Revenue follows from price and quantity, so it is computed where the shuffles have ended."""
    from ledgerline.plans.lakehouse import rebalance_by_store

    spark = smj_only
    sales = spark.createDataFrame(
        [("T1", "C1", "P1", "S1", 3, Decimal("2.50"), Decimal("7.50"), None), ("T2", "C2", None, None, 1, Decimal("1.00"), Decimal("1.00"), None)],
        "transaction_id string, customer_id string, product_id string, store_id string, quantity int, "
        "price decimal(12,2), revenue decimal(23,2), timestamp timestamp_ntz",
    )
    customers = spark.createDataFrame([("C1", "n", "c", "s"), ("C1", "m", "d", "t")], "customer_id string, name string, city string, segment string")
    products = spark.createDataFrame([("P1", "k", "b")], "product_id string, category string, brand string")
    enriched = marts.enrich(sales, customers, products)
    assert sorted((r.transaction_id, r.revenue, r.customer_name) for r in enriched.collect()) == [
        ("T1", Decimal("7.50"), "m"), ("T1", Decimal("7.50"), "n")
    ]
    assert enriched.schema["revenue"].dataType == sales.schema["revenue"].dataType
    dealt = rebalance_by_store(sales)
    assert dealt.columns == sales.columns and sorted(dealt.collect()) == sorted(sales.collect())
    for df, below in ((enriched, "Join"), (dealt, "RebalancePartitions")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert below in plan and "revenue" in plan
        assert "revenue" not in plan[plan.index(below):].split("LogicalRDD")[0]
        assert all("revenue" not in line for line in plan[plan.index(below):].splitlines() if "Project" in line)
