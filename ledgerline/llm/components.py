"""Connected components by alternating large-star and small-star steps.

Each step replaces edges by edges to the smallest neighbour seen so far
(aggregation with map-side combine, then an equi-join on the node that adaptive
execution may split); the edges become stars around the smallest node of
their component. Every round is written to the shared folder, so the lineage
stays short and a lost executor costs one re-read. Rounds grow with the
logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import shared_dir


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b) with a > b; returns edges of the same kind.

    large: each node sends its larger neighbours to its smallest one; small:
    each node sends itself and its smaller neighbours there.
    """
    if large:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b"))
        )
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges``.

    ``edges``: two long columns (a, b); loops and repeats are allowed. Nodes
    without an edge give no row.
    """
    spark = edges.sparkSession
    root = shared_dir(spark, "components")

    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema("a long, b long").parquet(f"{root}/{name}")

    a, b = edges.columns
    now = stored(
        "0",
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(),
    )
    seen = None
    for i in range(1, max_rounds + 1):
        now = stored(f"{i}", _star(_star(now, True), False))
        # The edges are a set: equal counts and combined hashes mean that nothing changed.
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
