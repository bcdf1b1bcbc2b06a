"""Importance resampling towards a target text distribution, with exact ranks.

Weights. Every run of 1 to ``run`` consecutive words is a feature, and a
feature's bucket is its crc32 modulo ``buckets``. One count per bucket over all
documents and one over all target texts give an array of integer log-ratio
gains; a document's weight is the floored mean over its features. Adding Gumbel
noise that is a function of the document's id makes the highest scores a
weighted sample without replacement.

Ranks. The scores are sorted by regular sampling:

- each task sorts its run of rows locally and gives every k-th row as a sample;
- the sorted samples give regular splitters, so that no segment holds more than
  about twice its share of rows, whatever the keys (each row's key is unique);
- rows go to their segments, where they are merged by one local sort;
- the counts of the segments, summed up, are what is added to a row's place in
  its segment: its exact rank.

How the work is spread: counts meet in an aggregation over at most ``buckets``
keys after they were added up in each task; the gains (``buckets`` numbers)
travel with the closure. One row of numbers per document is written, and only
those rows are sorted. Segments hold ``segment`` rows, more once there are
``segments`` of them; samples go to the driver up to ``SAMPLES`` of them, and
are ranked by this same sort beyond.

Defined cases: a null or empty text has no features and weight 0; a null id
is hashed as an empty text and comes before all others among equal scores;
rows that are repeated are rows of their own, each with its own rank;
documents with fewer than ``least_words`` words are never drawn; without target
texts, or without documents, all counts are zero. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.session import shared_dir

SAMPLES = 200_000  # rows
# Every byte that no word holds becomes a blank, A-Z become lower case; a word
# is [0-9a-z] and all beyond ASCII.
WORD_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


@dataclass(frozen=True)
class ResampleParams:
    run: int = 1  # words in the longest feature
    buckets: int = 10_000
    scale: int = 1000  # of gains and noise
    salt: str = "2024:"
    least_words: int = 20
    percent: int = 10
    segment: int = 16_384
    segments: int = 4096


# ------------------------------------------------------------------ weights


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


def feature_buckets(words: list[bytes], p: ResampleParams) -> np.ndarray:
    """The bucket of every feature, repeats included."""
    marks = [np.fromiter(map(crc32, words), np.int64, len(words))]
    for m in range(2, p.run + 1):
        n = max(len(words) - m + 1, 0)
        marks.append(np.fromiter((crc32(b" ".join(words[i : i + m])) for i in range(n)), np.int64, n))
    return np.concatenate(marks) % p.buckets


def bucket_counts(texts: DataFrame, text: str, p: ResampleParams) -> np.ndarray:
    """How many features of all texts each bucket has."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(p.buckets, np.int64)
        for batch in batches:
            for t in batch.column(0):
                counts += np.bincount(feature_buckets(words_of(t.as_py()), p), minlength=p.buckets)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], names=["bucket", "n"])

    parts = texts.select(text).mapInArrow(partial, "bucket long, n long")
    out = np.zeros(p.buckets, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():  # at most ``buckets`` rows
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray, p: ResampleParams) -> np.ndarray:
    """floor(scale * ln of the smoothed ratio of shares), by bucket."""
    s_all, t_all = float(source.sum() + p.buckets), float(target.sum() + p.buckets)
    ratios = [(t + 1.0) * s_all / ((s + 1.0) * t_all) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(p.scale * math.log(r)) for r in ratios], np.int64)


def weigh(text: Column, gain: np.ndarray, p: ResampleParams) -> Column:
    """struct(n_words, n_features, weight) of a text."""

    kind = pa.struct([("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    @F.arrow_udf("n_words long, n_features long, weight long")
    def weight(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = np.zeros((3, len(batch)), np.int64)
            for i, t in enumerate(batch):
                words = words_of(t.as_py())
                at = feature_buckets(words, p)
                rows[:, i] = len(words), len(at), int(gain[at].sum()) // len(at) if len(at) else 0
            yield pa.StructArray.from_arrays([pa.array(r) for r in rows], fields=list(kind))

    return weight(text)


def gumbel(doc_id: Column, p: ResampleParams) -> Column:
    """floor(scale * Gumbel noise), the uniform number being the id's hash."""
    text = F.concat(F.lit(p.salt), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(p.scale)) * F.log(-F.log(uniform))).cast("long")


# ------------------------------------------------------------------ ranks


def _sortable(columns: list[np.ndarray]) -> np.ndarray:
    """Rows of longs as byte strings in the same order."""
    flat = np.stack([c.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for c in columns], axis=1)
    return flat.astype(">u8").view(f"S{8 * len(columns)}").reshape(-1)


def _splitters(runs: DataFrame, order: list[str], every: int, parts: int) -> np.ndarray:
    """At most ``parts`` - 1 rows (as byte strings) that divide the samples into equal shares."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = 0
        for batch in batches:
            yield batch.take(pa.array(np.arange((every // 2 - passed) % every, batch.num_rows, every)))
            passed += batch.num_rows

    shape = ", ".join(f"{c} long" for c in order)
    picked = runs.sortWithinPartitions(*order).select(*order).mapInArrow(sample, shape)
    path = shared_dir(runs.sparkSession, "psrs")
    picked.write.parquet(path)
    picked = runs.sparkSession.read.schema(shape).parquet(path)
    n = picked.count()
    if n <= SAMPLES:
        rows = picked.toArrow()
        keys = np.sort(_sortable([rows.column(c).to_numpy() for c in order]))
        return keys[[i * n // parts for i in range(1, parts)]] if n else keys
    step = n // parts
    ranked = exact_ranks(picked, order, max(n // parts, 16_384), parts, "place")
    rows = ranked.filter(F.col("place") % step == 0).select(*order).toArrow()  # at most 2 * parts
    return np.sort(_sortable([rows.column(c).to_numpy() for c in order]))


def exact_ranks(rows: DataFrame, order: list[str], segment: int, segments: int, name: str = "rank") -> DataFrame:
    """``rows`` with their places from 1 in the order of some long columns, none of them null.

    No two rows may agree in all of ``order``. ``rows`` are read several times,
    so they should be a stored table.
    """
    by_run = rows.select(F.spark_partition_id().alias("run")).groupBy("run").agg(F.count("*").alias("n"))
    n, runs = by_run.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    share = max(segment, -(-n // segments), 1)
    parts = -(-n // share)
    if parts > 1:
        # A segment gets its share and at most ``every`` rows more of each run.
        cuts = _splitters(rows, order, max(16, share // max(runs, 1)), parts)

        @F.arrow_udf("int")
        def segment_of(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for columns in batches:
                keys = _sortable([c.to_numpy(zero_copy_only=False) for c in columns])
                yield pa.array(np.searchsorted(cuts, keys, side="right").astype(np.int32))

        placed = rows.withColumn("segment", segment_of(*order))
    else:
        placed = rows.withColumn("segment", F.lit(0))
    sizes = sorted(placed.groupBy("segment").agg(F.count("*")).collect())  # one row a segment
    before, total = [], 0
    for number, size in sizes:
        before.append((number, total))
        total += size
    spark = rows.sparkSession
    offsets = spark.createDataFrame(before, "segment int, before long")
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*order))
    return (
        placed.withColumn(name, place.cast("long"))
        .join(F.broadcast(offsets), "segment")
        .withColumn(name, F.col(name) + F.col("before"))
        .drop("segment", "before")
    )


# ------------------------------------------------------------------ operator


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    params: ResampleParams = ResampleParams(),
) -> DataFrame:
    """doc_id, n_features, weight, score, rank (null where not drawn) of every document."""
    p, spark = params, docs.sparkSession
    gain = gains(bucket_counts(docs, text, p), bucket_counts(target, target_text, p), p)
    path = shared_dir(spark, "resample")
    (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), weigh(F.col(text), gain, p).alias("w"))
        .select("doc_id", "w.*", (F.col("w.weight") + gumbel(F.col("doc_id"), p)).alias("score"))
        .select("*", F.monotonically_increasing_id().alias("row"))
        .write.parquet(path)
    )
    shape = "doc_id long, n_words long, n_features long, weight long, score long, row long"
    scored = spark.read.schema(shape).parquet(path)
    able = scored.filter(F.col("n_words") >= p.least_words)
    keys = able.select(
        "*",
        (-F.col("score")).alias("by_score"),
        F.coalesce("doc_id", F.lit(-(2**63))).alias("by_id"),
    )
    drawn = F.floor(F.lit(p.percent) * able.count() / 100).cast("long")
    ranked = exact_ranks(keys, ["by_score", "by_id", "row"], p.segment, p.segments)
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionAll(
        scored.filter(F.col("n_words") < p.least_words).select(*out, F.lit(None).cast("long").alias("rank"))
    )
