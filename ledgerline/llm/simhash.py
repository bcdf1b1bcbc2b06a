"""SimHash near-duplicates by multi-index hashing.

The 64-bit fingerprint of a text has a bit set where more than half of its
shingle hashes have it. Two fingerprints within ``distance`` bits are linked;
a group is a connected component of links.

Multi-index hashing: the fingerprint is cut into segments, here two halves of
32 bits. Of at most 3 differing bits one half holds at most 1, so the small
Hamming ball of a half, 33 values, finds the other one in a table of halves, and
the complete distance of each match is verified. Where two halves differ in a
bit, one of them has a 0 there and finds the other; so each fingerprint looks
up its own value and those with one more bit set, about half the ball. Random
texts hardly meet in 32 bits, so the matches stay in proportion to the input.

A table entry (half, value) that holds more than ``BUCKET`` different
fingerprints is searched by a second level: the other half differs in at most
3 bits, so one of its two 16-bit quarters differs in at most 1; look-ups carry
the ball of that quarter too, 48 bits in all. An entry of that level holds at
most 2^16 fingerprints whatever the input, so no bucket is unbounded and no
pair is left out.

Copies are collapsed first: everything works on distinct fingerprints, with
the smallest id of each, so a group of equal texts costs one row.

Defined cases: a null or empty text, or one of white space only, has
fingerprint zero, linked like any other; fewer words than the shingle length
are one shingle; repeated rows and repeated ids share a fingerprint if their
texts do; null ids are kept, never name a component unless all its ids are null
(then it is null); an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_words, fresh
from ledgerline.llm.components import components
from ledgerline.session import shared_dir

SEED = 42
HALF = 32
BUCKET = 256


def simhash(text: str | None, shingle: int = 3) -> int:
    """The fingerprint as a signed 64-bit integer."""
    import xxhash

    words = ascii_words(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    stop = ends[min(shingle, len(words)) - 1 :]
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), stop.tolist())], dtype=">u8"
    )
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 65536):
        bits = np.unpackbits(hashes[lo : lo + 65536].view(np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The fingerprint of each text, as a long."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    return run(text)


def _ball(value: str, bits: int) -> str:
    """SQL array: a value and all values one bit away."""
    return f"concat(array({value}), transform(sequence(0, {bits - 1}), i -> {value} ^ shiftleft(1L, i)))"


def _rises(value: str, bits: int) -> str:
    """SQL array: a value and all values with one more bit set (that half of the ball which lies above it)."""
    zeros = f"filter(sequence(0, {bits - 1}), i -> {value} & shiftleft(1L, i) = 0)"
    return f"concat(array({value}), transform({zeros}, i -> {value} | shiftleft(1L, i)))"


def _halves() -> str:
    """SQL array of (half, its value, the other half's value)."""
    low, high = "fp & 4294967295L", "shiftrightunsigned(fp, 32)"
    return (
        f"array(named_struct('half', 0, 'own', {low}, 'other', {high}), "
        f"named_struct('half', 1, 'own', {high}, 'other', {low}))"
    )


def _quarters(value: str) -> str:
    """SQL array of (quarter, its value)."""
    return (
        f"array(named_struct('quarter', 0, 'part', {value} & 65535L), "
        f"named_struct('quarter', 1, 'part', shiftrightunsigned({value}, 16)))"
    )


def links(prints: DataFrame, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(a, b), a < b: the pairs of distinct fingerprints (column fp) at most ``distance`` bits apart."""
    if not 0 <= distance <= 3:
        raise ValueError("two halves and balls of one bit find distances up to 3")
    table = prints.select("fp", F.explode(F.expr(_halves())).alias("h")).select(
        "h.half", "h.own", "h.other", "fp"
    )
    probes = table.select(
        "half",
        F.explode(F.expr(_rises("own", HALF))).alias("own"),
        "other",
        F.col("fp").alias("a"),
        F.col("own").alias("start"),
    )
    sizes = table.groupBy("half", "own").agg(F.count("*").alias("n"))
    large = sizes.filter(F.col("n") > bucket).select("half", "own")
    small = table.join(large, ["half", "own"], "left_anti").select("half", "own", F.col("fp").alias("b"))
    # Equal halves find each other both ways, others one way.
    once = (F.col("own") != F.col("start")) | (F.col("a") < F.col("b"))
    near = once & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    pair = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    first = probes.join(small, ["half", "own"]).filter(near).select(*pair)
    # Second level, for the large entries only.
    quarter = lambda df, *who: df.join(large, ["half", "own"], "left_semi").select(
        "half", "own", F.explode(F.expr(_quarters("other"))).alias("q"), *who
    ).select("half", "own", "q.quarter", "q.part", *who)
    inner = quarter(table.withColumnRenamed("fp", "b"), "b")
    outer = quarter(probes, "a", "start").select(
        "half", "own", "quarter", F.explode(F.expr(_ball("part", 16))).alias("part"), "a", "start"
    )
    second = outer.join(inner, ["half", "own", "quarter", "part"]).filter(near).select(*pair)
    return first.unionAll(second).distinct()


def groups(prints: DataFrame, distance: int = 3) -> DataFrame:
    """(fp, group): the connected component of each distinct fingerprint (column fp)."""
    linked = components(links(prints, distance))
    return prints.join(linked, prints.fp == linked.node, "left").select(
        "fp", F.coalesce("component", "fp").alias("group")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``.

    ``component_id`` is the smallest id of the row's group.
    """
    spark = docs.sparkSession
    root = shared_dir(spark, "simhash")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), fingerprint(F.col(text), shingle).alias("fp"))
    rows.write.parquet(f"{root}/rows")
    rows = spark.read.schema("doc_id long, fp long").parquet(f"{root}/rows")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    distinct.write.parquet(f"{root}/distinct")
    distinct = spark.read.schema("fp long, first long").parquet(f"{root}/distinct")
    linked = components(links(distinct.select("fp"), distance))
    groups = distinct.join(linked, distinct.fp == linked.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("group")
    )
    smallest = groups.groupBy("group").agg(F.min("first").alias("component_id"))
    named = groups.join(smallest, "group").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """One row of each group: that of its smallest id; of equal ids, or where all are null, one of them.

    The columns of ``docs`` are returned as they are.
    """
    spark, path = docs.sparkSession, shared_dir(docs.sparkSession, "simhash_keep")
    mark = fresh("mark", docs.columns)
    number = fresh("number", docs.columns)
    marked = docs.withColumn(mark, fingerprint(F.col(text), shingle)).withColumn(
        number, F.monotonically_increasing_id()
    )
    marked.write.parquet(path)
    marked = spark.read.schema(marked.schema).parquet(path)
    slim = marked.select(
        F.col(doc_id).cast("long").alias("id"), F.col(mark).alias("fp"), F.col(number).alias("number"),
    )
    # Of each fingerprint one row: the smallest id, then the first row.
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "number"))
    distinct = slim.groupBy("fp").agg(best.alias("best"))
    distinct.write.parquet(f"{path}_distinct")
    distinct = spark.read.schema(distinct.schema).parquet(f"{path}_distinct")
    linked = components(links(distinct.select("fp"), distance))
    kept = (
        distinct.join(linked, distinct.fp == linked.node, "left")
        .groupBy(F.coalesce("component", "fp"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.number").alias("kept"))
    )
    return marked.join(kept, marked[number] == kept["kept"], "left_semi").drop(mark, number)
