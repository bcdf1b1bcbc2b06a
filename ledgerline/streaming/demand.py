"""Windowed product demand and demand-spike detection.

``windowed_demand`` is one transformation for batch and streaming input: the
batch twin of the stream query is the same function on a static DataFrame.
On a stream, pass ``watermark`` so state is bounded and windows are emitted
in append mode once the watermark passes their end; rows later than the
watermark are dropped by Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import money_out
from ledgerline.operators.quality import clean_sales
from ledgerline.params import RetailParams

WINDOW_COLUMNS = ("window_start", "window_end", "product_id", "total_qty", "window_revenue")


def event_time(sales: DataFrame, params: RetailParams = RetailParams()) -> DataFrame:
    """Cleaned rows with ``event_time`` (TIMESTAMP) and ``revenue``."""
    cleaned = clean_sales(sales, params)
    return cleaned.withColumn("event_time", F.col("timestamp").cast("timestamp"))


def windowed_demand(
    sales: DataFrame,
    window: str = "1 minute",
    watermark: str | None = None,
    params: RetailParams = RetailParams(),
) -> DataFrame:
    """Tumbling-window demand per product.

    (window_start, window_end, product_id, total_qty BIGINT,
    window_revenue DOUBLE). Window bounds are returned as TIMESTAMP_NTZ
    wall-clock values of the session time zone.
    Rows with a NULL event time belong to no window.
    """
    timed = event_time(sales, params)
    if watermark is not None:
        timed = timed.withWatermark("event_time", watermark)
    agg = timed.groupBy(F.window("event_time", window).alias("w"), "product_id").agg(
        F.sum("quantity").alias("total_qty"),
        F.sum("revenue").alias("rev"),
    )
    return agg.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "product_id",
        F.col("total_qty").cast("bigint").alias("total_qty"),
        money_out("rev").alias("window_revenue"),
    )


def demand_spikes(windows: DataFrame, factor=RetailParams().spike_factor) -> DataFrame:
    """Windows whose quantity exceeds ``factor`` x the mean window quantity.

    The baseline is the mean over all product-windows (each window included),
    0 when there are none. It enters as one scalar subquery, and the test is
    done exactly in integers/decimals: total_qty * n > factor * sum.

    Windows are counted through ``window_revenue`` (never NULL for a window)
    so the subquery needs the same aggregate columns as the main query; when
    ``windows`` is an aggregation, Spark then reuses its shuffle for the
    baseline instead of aggregating the events a second time.
    """
    baseline = windows.agg(
        F.struct(
            F.coalesce(F.sum("total_qty"), F.lit(0)).alias("s"),
            F.count("window_revenue").alias("n"),
        )
    ).scalar()
    cond = F.col("total_qty") * baseline.getField("n") > F.lit(factor) * baseline.getField("s")
    return windows.filter(cond).select(*WINDOW_COLUMNS)


def late_demand(complete: DataFrame, stored: DataFrame) -> DataFrame:
    """What came too late for the stream, by window and product.

    ``complete``: closed windows over all rows (the batch twin); ``stored``: the
    stream's sink. (window_start, window_end, product_id, total_qty, stored_qty,
    late_qty), only where a quantity is missing.
    """
    keys = ["window_start", "window_end", "product_id"]
    kept = stored.select(*keys, F.col("total_qty").alias("stored_qty"))
    both = complete.select(*keys, "total_qty").join(kept, keys, "left")
    missing = F.col("total_qty") - F.coalesce("stored_qty", F.lit(0))
    return both.select(
        *keys, "total_qty", F.coalesce("stored_qty", F.lit(0)).alias("stored_qty"), missing.alias("late_qty")
    ).filter("late_qty <> 0")
