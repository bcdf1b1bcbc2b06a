"""Hard negatives by Fagin's threshold algorithm over integer vectors.

For every anchor its best rows of the same label are its positives; for every
positive the best rows of other labels are wanted whose score lies within a
window that the positive's score sets. Both are searched alike:

- an index holds, for each dimension, the rows in order of their component;
- an anchor reads the lists of all dimensions in parallel, from the top where
  its own component is positive and from the bottom where it is negative
  (sorted access), a stretch of each list at a time;
- every row met for the first time is scored in full in exact integers (random
  access);
- the components at which the lists stand, weighted by the anchor's, add up to
  the threshold: no row that was not met scores more. The reading stops once
  the threshold lies strictly below each window's k-th score, or below the
  window itself; a row that could tie is always met.

How the work is spread: rows are dealt by hash of their id to shards of bounded
bytes, anchors to blocks; each block meets each shard in an equi-join on the
shard's number, and each pair gives at most k rows per window, which one window
function merges. Positives are merged and written first, since their scores
set the windows of the second search. Nothing is broadcast, nothing sampled.

Defined cases: a row whose id, label or vector is null, or whose vector holds a
null or non-finite component, takes no part; vectors of other lengths count
as filled up with zeros; several rows of one id count as the smallest of them
(by label, then vector); an anchor without others of its label gives no rows;
a positive with a negative score has an empty window; equal scores go to the
smaller id. Scores that do not fit 64 bits are counted exactly and returned as
the nearest long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.session import shared_dir

STRETCH = 32  # rows of a list read at first; doubled each time
LONG = 2**63 - 1


def exact_type(rows: np.ndarray, query: np.ndarray):
    """A numpy type in which every inner product is an exact integer."""
    top = lambda x: max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    bound = top(rows) * top(query) * max(rows.shape[-1], 1)
    return np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object


class SortedLists:
    """One shard: its rows, and for each dimension the rows by their component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.order = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.ascontiguousarray(np.take_along_axis(rows.T, self.order, axis=1))
        self.typed: dict = {np.int64: rows}

    def matrix(self, kind):
        if kind not in self.typed:
            self.typed[kind] = self.rows.astype(kind)
        return self.typed[kind]

    def search(
        self, query: np.ndarray, own_id: int, own_label: int, same: bool, windows: list[tuple], k: int
    ) -> list[list[tuple[int, int]]]:
        """For each window (low, high; None is open) the k best (score, id) of rows with or without the label."""
        n, kind = len(self.ids), exact_type(self.rows, query)
        rows, q = self.matrix(kind), query.astype(kind)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        wanted = ((self.labels == own_label) == same) & (self.ids != own_id)
        seen = np.zeros(n, bool)
        found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, kind), np.zeros(0, np.int64)) for _ in windows]
        at, to = 0, min(STRETCH, n)
        while at < n:
            if len(up) + len(down):
                met = np.concatenate([self.order[up, n - to : n - at].reshape(-1), self.order[down, at:to].reshape(-1)])
                threshold = q[up] @ self.sorted[up, n - to].astype(kind) + q[down] @ self.sorted[down, to - 1].astype(kind)
            else:  # every score is zero
                met, threshold, to = np.arange(n), 0, n
            new = np.zeros(n, bool)
            new[met] = True
            new &= ~seen
            seen |= new
            hits = np.flatnonzero(new & wanted)
            scores, ids = rows[hits] @ q, self.ids[hits]
            done = True
            for i, (low, high) in enumerate(windows):
                inside = np.ones(len(hits), bool)
                if low is not None:
                    inside &= (scores >= low).astype(bool) & (scores <= high).astype(bool)
                s = np.concatenate([found[i][0], scores[inside]])
                v = np.concatenate([found[i][1], ids[inside]])
                if len(s) > k:
                    best = np.lexsort((v, -s))[:k]
                    s, v = s[best], v[best]
                found[i] = (s, v)
                full = len(s) == k and threshold < s.min()
                done &= bool(full or (low is not None and (threshold < low or low > high)))
            if done:
                break
            at, to = to, min(2 * to, n)
        return [[(int(a), int(b)) for a, b in zip(s, v)] for s, v in found]


def window_of(positive: int, low: tuple[int, int], high: tuple[int, int]) -> tuple[int, int]:
    """The integer scores s with low * positive <= s <= high * positive, both as fractions."""
    return -(-positive * low[0] // low[1]), positive * high[0] // high[1]


def _blobs(rows: DataFrame, key: str, dims: int) -> DataFrame:
    """(key, ids, labels, vectors, scores): the rows of each key as byte strings; scores stay lists."""

    def gather(table: pa.Table) -> pa.Table:
        n = table.num_rows
        flat = np.zeros((n, dims), np.int64)
        lists = table.column("v").combine_chunks()
        values, sizes = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy()
        flat[np.arange(dims) < sizes[:, None]] = values
        return pa.table(
            {
                key: pa.array([table.column(key)[0].as_py()], pa.int32()),
                "ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()),
                "labels": pa.array([table.column("label").to_numpy().tobytes()], pa.binary()),
                "vectors": pa.array([flat.tobytes()], pa.binary()),
                "scores": pa.array([table.column("scores").to_pylist()], pa.list_(pa.list_(pa.int64()))),
            }
        )

    shape = f"{key} int, ids binary, labels binary, vectors binary, scores array<array<long>>"
    return rows.groupBy(key).applyInArrow(gather, shape)


def _search(index: DataFrame, anchors: DataFrame, shards: int, blocks: int, dims: int, same: bool, k: int, low, high):
    """(anchor_id, positive_score, vec_id, score): at most k rows of each shard for each window of each anchor.

    ``anchors``: vec_id, label, v, scores; a score of an anchor sets a window,
    and without ``low`` there is one open window for an anchor.
    """
    deal = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int")
    asked = _blobs(anchors.withColumn("block", deal), "block", dims)
    sent = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        *[F.col(c).alias(f"q_{c}") for c in ("ids", "labels", "vectors", "scores")],
    )
    pairs = index.join(sent, "shard").select(
        "shard", "ids", "labels", "vectors", "q_ids", "q_labels", "q_vectors", "q_scores"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, lists = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                shard, ids, labels, vectors, q_ids, q_labels, q_vectors, scores = (c[row].as_py() for c in batch.columns)
                if shard != number:
                    own = np.frombuffer(ids, np.int64)
                    matrix = np.frombuffer(vectors, np.int64).reshape(len(own), -1)
                    number, lists = shard, SortedLists(own, np.frombuffer(labels, np.int64), matrix)
                asked_ids = np.frombuffer(q_ids, np.int64)
                queries = np.frombuffer(q_vectors, np.int64).reshape(len(asked_ids), -1)
                out: list[tuple] = []
                for a, label, q, marks in zip(
                    asked_ids.tolist(), np.frombuffer(q_labels, np.int64).tolist(), queries, scores
                ):
                    marks = sorted(set(marks)) if low else [0]
                    windows = [window_of(m, low, high) if low else (None, None) for m in marks]
                    for m, best in zip(marks, lists.search(q, a, label, same, windows, k)):
                        out += [(a, m, v, max(-LONG - 1, min(LONG, s))) for s, v in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], pa.int64()) for i in range(4)],
                    names=["anchor_id", "positive_score", "vec_id", "score"],
                )

    return pairs.mapInArrow(work, "anchor_id long, positive_score long, vec_id long, score long")


def mine(
    rows: DataFrame,
    vec_id: str,
    label: Column,
    components: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: tuple[int, int] = (30, 100),
    high: tuple[int, int] = (90, 100),
    shard: int = 16_384,
    shard_bytes: int = 16_000_000,
    block: int = 2_048,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``components``: array<long>, null where a row takes no part; a negative's
    score lies between ``low`` and ``high`` (fractions) of its positive's.
    """
    spark = rows.sparkSession
    root = shared_dir(spark, "negatives")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    known = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        components.alias("v"),
        is_anchor.alias("anchor"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    known = known.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"), F.max("anchor").alias("anchor"))
    known = stored(known.select("vec_id", "r.label", "r.v", "anchor"), "rows")
    n, asked, dims = known.agg(F.count("*"), F.count_if("anchor"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    size = max(1, min(shard, shard_bytes // (8 * max(dims, 1))))
    shards, blocks = max(1, math.ceil(n / size)), max(1, math.ceil(asked / block))
    none = F.lit(None).cast("array<long>").alias("scores")
    deal = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).cast("int").alias("shard")
    index = _blobs(known.select("vec_id", "label", "v", deal, none), "shard", dims).drop("scores")
    anchors = known.filter("anchor").select("vec_id", "label", "v")

    def first(df: DataFrame, most: int, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("vec_id"))
        return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    near = _search(index, anchors.select("*", none), shards, blocks, dims, True, positives, None, None)
    near = first(near, positives, "anchor_id").select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    near = stored(near, "positives")
    marks = near.groupBy("anchor_id").agg(F.collect_set("positive_score").alias("scores"))  # at most ``positives``
    marked = anchors.join(marks, anchors["vec_id"] == marks["anchor_id"]).drop("anchor_id")
    far = _search(index, marked, shards, blocks, dims, False, negatives, low, high)
    far = first(far, negatives, "anchor_id", "positive_score")
    return near.join(far, ["anchor_id", "positive_score"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
