"""Bronze / silver / gold Parquet layers.

- bronze: each source landed untransformed (all strings for CSV);
- silver: cleaned sales partitioned by ``store_id`` plus key-checked dims;
- gold:   the fact table, the four marts and the daily revenue.

Row counts for the audit log come from ``DataFrame.observe`` inside the write
job itself, not from extra ``count()`` jobs. Marts are written without a
global sort (row order inside Parquet files is no contract).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.money import revenue
from ledgerline.operators import marts, quality, star
from ledgerline.operators.quality import dimension
from ledgerline.params import RetailParams
from ledgerline.schemas import LAYER_CODEC, silver_sales_schema


def _write_observed(df: DataFrame, path: str, name: str, partition_by: str | None = None) -> int:
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite").option("compression", LAYER_CODEC)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return int(obs.get["rows"])


def land_bronze(spark: SparkSession, sources: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Write each raw source under ``root/bronze/<name>``; returns row counts."""
    return {
        name: _write_observed(df, f"{root}/bronze/{name}", f"bronze_{name}")
        for name, df in sources.items()
    }


def rebalance_by_store(clean: DataFrame) -> DataFrame:
    """Shuffle on ``store_id`` with AQE rebalancing before the partitioned write.

    A plain ``repartition('store_id')`` would send a whole store (which may
    hold a third of all rows) to one task and write it as one huge file; not
    shuffling at all writes one small file per store per input task. The
    ``rebalance`` hint lets AQE split an oversized store partition into
    chunks of ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and merge
    small ones, so the number of files per store follows the data volume and
    every task writes a bounded amount. ``revenue`` is not shuffled: it follows
    from the price and the quantity.
    """
    dealt = clean.drop("revenue").hint("rebalance", "store_id")
    return dealt.withColumn("revenue", revenue()).select(*clean.columns)


def write_silver_sales(clean: DataFrame, root: str) -> int:
    """Silver sales only: partitioned by store, rebalanced against hot stores."""
    return _write_observed(rebalance_by_store(clean), f"{root}/silver/sales", "silver_sales", "store_id")


def write_silver_sales_counting_rejects(
    raw: DataFrame, root: str, params: RetailParams = RetailParams()
) -> tuple[int, dict[str, int]]:
    """Clean raw sales and write silver, counting rejects by reason in the same job.

    The reject counts are observed on the raw rows inside the write job, so
    the input is read once for both the silver table and the reject report.
    Returns (rows written, {reason: n} for reasons that occurred).
    """
    reason = quality.reject_reason(raw, params)
    obs = Observation("silver_rejects")
    counted = raw.observe(obs, *[F.count_if(reason == F.lit(r)).alias(r) for r in quality.REASONS])
    written = write_silver_sales(quality.clean_sales(counted, params), root)
    rejects = {k: int(v) for k, v in obs.get.items() if v}
    return written, rejects


def write_rejects(raw: DataFrame, root: str, params: RetailParams = RetailParams()) -> None:
    """Every rejected row with its reason, as a table ``root/silver/rejects``."""
    quality.rejected_records(raw, params).write.mode("overwrite").parquet(f"{root}/silver/rejects")


def sales_audit(spark: SparkSession, root: str) -> DataFrame:
    """(layer, n): rows of bronze (where landed) and silver sales, and of rejects by reason.

    Counted from committed files, so a task or stage that was retried while
    they were written counts once.
    """
    silver = read_silver_sales(spark, root).agg(F.count("*").alias("n")).select(F.lit("silver").alias("layer"), "n")
    rejects = (
        spark.read.schema("reason string").parquet(f"{root}/silver/rejects")
        .groupBy("reason")
        .agg(F.count("*").alias("n"))
        .select(F.concat(F.lit("rejected:"), "reason").alias("layer"), "n")
    )
    return silver.unionAll(rejects)


def write_silver_dims(customers: DataFrame, products: DataFrame, root: str) -> dict[str, int]:
    """Silver dimensions: key present (K3); duplicates are kept and reported."""
    return {
        "customers": _write_observed(
            dimension(customers, "customer_id"), f"{root}/silver/customers", "silver_customers"
        ),
        "products": _write_observed(
            dimension(products, "product_id"), f"{root}/silver/products", "silver_products"
        ),
    }


def write_silver(
    clean: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    root: str,
) -> dict[str, int]:
    return {"sales": write_silver_sales(clean, root), **write_silver_dims(customers, products, root)}


def read_silver_sales(
    spark: SparkSession, root: str, store: str | None = None, timestamp_type=None
) -> DataFrame:
    """Read silver sales with an explicit schema (store ids stay strings).

    Filtering on ``store`` prunes the other store directories at planning
    time (``PartitionFilters`` in the scan).
    """
    df = spark.read.schema(silver_sales_schema(timestamp_type)).parquet(f"{root}/silver/sales")
    if store is not None:
        df = df.filter(F.col("store_id") == F.lit(store))
    return df


def write_gold(
    clean: DataFrame, customers: DataFrame, products: DataFrame, root: str
) -> dict[str, int]:
    """Gold fact + marts. The enriched join is written once as the gold fact
    view used by every mart, so the star join runs once per build instead of
    once per mart."""
    counts = {"fact_sales": _write_observed(star.fact_sales(clean), f"{root}/gold/fact_sales", "gold_fact")}
    enriched_path = f"{root}/gold/enriched_sales"
    counts["enriched_sales"] = _write_observed(
        marts.enrich(clean, customers, products), enriched_path, "gold_enriched"
    )
    spark = clean.sparkSession
    enriched = spark.read.parquet(enriched_path)
    outputs = {
        "revenue_by_city": marts.gold_revenue_by_city(enriched),
        "revenue_by_category": marts.gold_revenue_by_category(enriched),
        "customer_segments": marts.gold_customer_segments(enriched),
        "monthly_trend": marts.gold_monthly_trend(enriched),
        "daily_revenue": marts.with_money_out(marts.daily_revenue(enriched), "daily_revenue"),
    }
    for name, df in outputs.items():
        counts[name] = _write_observed(df, f"{root}/gold/{name}", f"gold_{name}")
    return counts


def write_low_sales_alerts(enriched: DataFrame, params: RetailParams, root: str) -> int:
    """The alert rows (exact money) below ``gold/low_sales_alerts``; returns how many."""
    alerts = marts.low_sales_days(marts.daily_revenue(enriched), params.sales_alert_threshold)
    return _write_observed(alerts, f"{root}/gold/low_sales_alerts", "gold_alerts")
