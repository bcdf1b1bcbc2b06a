"""Bounded samples that the classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(col: str, salt: int) -> Column:
    return F.xxhash64(F.col(col), F.lit(salt))


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, most: int, salt: int = 1
) -> DataFrame:
    """At most ``most`` labelled documents: ``docs``' columns with ``label``, one row per id.

    The labels that come first by a hash of their id are taken, so the sample
    does not depend on the order of rows. They are at most ``most`` rows of two
    numbers, hence the broadcast: the documents are not shuffled for it. Of
    several labels of an id the largest counts, of several rows the smallest.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("l_id"), F.col(label).cast("int").alias("l_value"))
        .filter(F.col("l_id").isNotNull() & F.col("l_value").isNotNull())
        .filter(may_learn)
        .groupBy("l_id")
        .agg(F.max("l_value").alias("l_value"))
        .orderBy(_order("l_id", salt), "l_id")
        .limit(most)
    )
    met = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["l_id"])
    return _one_row(met, docs.columns, "l_value").withColumnRenamed("l_value", label)


def _one_row(df: DataFrame, columns: list[str], *more: str) -> DataFrame:
    rest = [c for c in columns if c != "doc_id"]
    one = F.min(F.struct(*[F.col(c) for c in [*rest, *more]])).alias("one")
    return df.groupBy("doc_id").agg(one).select("doc_id", "one.*")
