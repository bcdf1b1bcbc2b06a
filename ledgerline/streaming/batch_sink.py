"""A Parquet sink written once per micro-batch, idempotent by batch id.

``foreachBatch`` may call with the same batch again after a failure; each
batch owns the folder ``batch_id=<id>`` and replaces it whole, so a replayed
batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_batch(rows: DataFrame, batch_id: int, root: str) -> None:
    rows.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def read_batches(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Every stored batch, with its ``batch_id``."""
    return spark.read.schema(f"{schema}, batch_id bigint").option("basePath", root).parquet(root)


def latest_batch(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of the last batch (for a sink whose batches each hold the whole result)."""
    rows = read_batches(spark, root, schema)
    last = rows.agg(F.max("batch_id")).scalar()
    return rows.filter(F.col("batch_id") == last).drop("batch_id")


def drain_batches(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    mode: str = "append",
    after: Callable[[DataFrame, int], None] | None = None,
) -> int:
    """Drain a streaming frame into ``root``; the number of micro-batches with input.

    ``after(batch, id)`` is called once a batch is stored.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, root)
        if after is not None:
            after(batch, batch_id)

    query = (
        rows.writeStream.outputMode(mode)
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p["numInputRows"])
