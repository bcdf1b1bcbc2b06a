"""Conflict-constrained best-fit packing of documents into sequences.

A document is cut into pieces of at most ``capacity`` words (the last one is
shorter); each piece goes into a bin of ``capacity`` words. Two pieces
conflict if they belong to one duplicate cluster, or if the bin already holds
``per_source`` pieces of that source; every bin carries one bitmap of the
duplicate clusters in it and ``per_source`` bitmaps of its sources. Pieces are
taken longest first. The open bins are kept in order of their residual room;
from the smallest residual that is large enough, the search goes on to the
next larger one until it meets a bin without a conflict: the tightest
compatible bin. Only if there is none, a new bin is opened.

How the work is spread: only (id, piece, words, source, cluster) move, never
texts. Pieces are dealt by hash to shards of about ``shard`` pieces, so a hot
source or a large group of copies is spread over all shards, and each shard is
packed on its own, in bounded memory; shards are dealt to tasks by number.
Equal rows are first counted and then numbered, and the number is part of the
hash, so that even one row repeated over a third of the table is spread: a row
with many copies is cut into ranges of ``RANGE`` of them, which are dealt out
before they are numbered. The number of shards follows the number of pieces.
Results depend on the data alone, not on how it is partitioned.

Defined cases: a null or empty text has no words and gets no bin (no row); a
null source is a source of its own, a null id is kept as null; repeated rows
are packed as often as they occur, each into another bin (they are copies);
ties in length go by id, piece and number; pieces that fill a bin alone get
their own bin.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import simhash
from ledgerline.session import shared_dir

RANGE = 10_000  # copies numbered in one go
WORD = "[^\\x20\\x09-\\x0D]+"
OUT = (
    "bin_id string, slot int, has_id boolean, doc_id long, piece int, first_word long, "
    "n_words int, bin_words int"
)


class Bins:
    """Open bins in order of residual room, with bitmaps of what they hold."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity = capacity
        self.per_source = per_source
        self.by_residual: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0  # bit r: some bin has residual r
        self.sources: list[list[int]] = []  # by bin: bitmaps of sources held once, twice, ...
        self.clusters: list[int] = []
        self.rooms: list[int] = []
        # By residual, what every bin there holds (or more bins than are left there): no use to look at them.
        self.all_clusters = [-1] * (capacity + 1)
        self.all_sources = [-1] * (capacity + 1)

    def _compatible(self, b: int, source: int, cluster: int) -> bool:
        return not (self.sources[b][-1] & source or self.clusters[b] & cluster)

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin that takes a piece; ``source`` and ``cluster`` are one-bit masks (0: none)."""
        above = self.open >> size
        at = size
        while above:
            step = (above & -above).bit_length() - 1  # the next residual that some bin has
            at += step
            none = self.all_clusters[at] & cluster or self.all_sources[at] & source
            for i, b in enumerate(() if none else self.by_residual[at]):
                if self._compatible(b, source, cluster):
                    del self.by_residual[at][i]
                    if not self.by_residual[at]:
                        self.open &= ~(1 << at)
                        self.all_clusters[at] = self.all_sources[at] = -1
                    return self._add(b, size, source, cluster)
            above >>= step + 1
            at += 1
        self.sources.append([0] * self.per_source)
        self.clusters.append(0)
        self.rooms.append(self.capacity)
        return self._add(len(self.rooms) - 1, size, source, cluster)

    def _add(self, b: int, size: int, source: int, cluster: int) -> int:
        levels = self.sources[b]
        for k in range(self.per_source):
            if not levels[k] & source:
                levels[k] |= source
                break
        self.clusters[b] |= cluster
        self.rooms[b] -= size
        left = self.rooms[b]
        if left:
            self.by_residual[left].append(b)
            self.open |= 1 << left
            self.all_clusters[left] &= self.clusters[b]
            self.all_sources[left] &= levels[-1]
        return b


def _mask(values: pd.Series, shared_only: bool) -> list[int]:
    """A one-bit mask per value; 0 for values that occur once, if those can't conflict."""
    counts = values.value_counts()
    bit = {v: 1 << i for i, v in enumerate(counts.index[counts > 1] if shared_only else counts.index)}
    return [bit.get(v, 0) for v in values]


def pack_shard(pieces: pd.DataFrame, capacity: int, per_source: int) -> pd.DataFrame:
    """Pack one shard; bins are numbered in the order in which they are opened."""
    pieces = pieces.sort_values(
        ["n_words", "has_id", "doc_id", "piece", "copy", "cluster", "source"],
        ascending=[False, True, True, True, True, True, True],
    ).reset_index(drop=True)
    bins = Bins(capacity, per_source)
    sources = _mask(pieces["source"], False)
    clusters = _mask(pieces["cluster"], True)
    at = [bins.place(int(n), s, c) for n, s, c in zip(pieces["n_words"], sources, clusters)]
    pieces["bin"] = at
    pieces["slot"] = pieces.groupby("bin").cumcount().astype("int32")
    pieces["bin_id"] = [f"{s}-{b}" for s, b in zip(pieces["shard"], at)]
    pieces["bin_words"] = [capacity - bins.rooms[b] for b in at]
    return pieces[[c.split()[0] for c in OUT.split(", ")]]


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    cluster: Column | None = None,
    capacity: int = 2048,
    per_source: int = 2,
    shard: int = 8192,
    near: bool = False,
) -> DataFrame:
    """One row per packed piece: its bin, its place in the bin, and its words.

    ``cluster``: which rows are copies of each other; by default those whose
    text is equal but for case and the amount of white space. With ``near``
    (and no ``cluster``) those of one SimHash group, near copies too; the
    fingerprint is of the lower-cased words, so such equal texts are among them.
    """
    spark = docs.sparkSession
    same_text = F.xxhash64(F.lower(F.array_join("words", " ")))
    near = near and cluster is None
    if near:
        given = simhash.fingerprint(F.lower(F.col(text)))
    else:
        given = F.lit(0) if cluster is None else F.xxhash64(cluster)
    slim = (
        docs.select(
            F.col(doc_id).isNotNull().alias("has_id"),
            F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("doc_id"),
            F.col(source).cast("string").alias("source"),
            F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)).alias("words"),
            given.alias("given"),
        )
        .select(
            "has_id",
            "doc_id",
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source"),
            F.size("words").alias("n"),
            (same_text if cluster is None and not near else F.col("given")).alias("cluster"),
        )
        .filter("n > 0")
        .groupBy("has_id", "doc_id", "source", "n", "cluster")
        .agg(F.count("*").alias("copies"))
    )
    path = shared_dir(spark, "packing")
    slim.write.parquet(path)
    slim = spark.read.schema(slim.schema).parquet(path)
    if near:
        prints = slim.select(F.col("cluster").alias("fp")).distinct()
        prints.write.parquet(f"{path}_prints")
        named = simhash.groups(spark.read.schema("fp long").parquet(f"{path}_prints"))
        slim = slim.join(named, slim["cluster"] == named["fp"]).select(
            "has_id", "doc_id", "source", "n", F.col("group").alias("cluster"), "copies"
        )
        # Rows of one group and length are one row again, so that copies are numbered apart.
        slim = slim.groupBy("has_id", "doc_id", "source", "n", "cluster").agg(F.sum("copies").alias("copies"))
        slim.write.parquet(f"{path}_groups")
        slim = spark.read.schema(slim.schema).parquet(f"{path}_groups")
    n_pieces = F.ceil(F.col("n") / F.lit(capacity)).cast("int")
    total = slim.agg(F.sum(n_pieces * F.col("copies"))).first()[0] or 0
    shards = max(1, math.ceil(total / shard))
    few = F.col("copies") <= RANGE
    last = F.floor((F.col("copies") - 1) / RANGE).cast("long")
    ranges = (
        slim.filter(~few)
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("range"))
        .repartition("has_id", "doc_id", "source", "n", "cluster", "range")
        .select(
            *slim.columns,
            F.explode(
                F.sequence(F.col("range") * RANGE + 1, F.least(F.col("copies"), (F.col("range") + 1) * RANGE))
            ).alias("copy"),
        )
    )
    numbered = slim.filter(few).select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    pieces = (
        numbered.unionAll(ranges)
        .select("*", F.posexplode(F.sequence(F.lit(0), n_pieces - 1)).alias("piece", "at"))
        .select(
            "has_id",
            "doc_id",
            "source",
            "cluster",
            "copy",
            "piece",
            (F.col("piece").cast("long") * capacity).alias("first_word"),
            F.least(F.lit(capacity), F.col("n") - F.col("piece") * capacity).cast("int").alias("n_words"),
        )
        .withColumn(
            "shard",
            F.pmod(F.xxhash64("doc_id", "source", "cluster", "copy", "piece"), F.lit(shards)).cast("int"),
        )
    )

    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(pieces, capacity, per_source)

    tasks = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = pieces.repartitionById(tasks, "shard").groupBy("shard").applyInPandas(run, OUT)
    return packed.withColumn("doc_id", F.when(F.col("has_id"), F.col("doc_id"))).drop("has_id")
