"""Exact top-k search by inner product, with MaxScore.

Each component of the integer vectors is a query term with postings: the rows
whose component helps the query beyond a baseline of that term, in order of
the help. For a query weight q > 0 the help of a row is q * (x - base) with a
high quantile as base, for q < 0 it is |q| * (base - x) with a low one; rows
outside the postings help by nothing or less. So the sum of the terms' largest
helps, with the weighted baselines, bounds every score.

In a shard the rows that the strongest postings begin with give a first
threshold: k true scores. Terms are split by their bounds: as long as the
weakest ones together cannot reach the threshold they are non-essential, and a
row that stands in no essential posting cannot enter the result. The essential
postings are traversed; what they meet is scored term by term, strongest first,
and a row is dropped once its score so far and the bounds of the terms left
cannot reach the threshold (a row that could tie is kept). Every sixteen terms
the rows that lead are scored in full, which raises the threshold.

How the work is spread: vectors are dealt by hash of their id to shards of
about ``shard`` rows, fewer where these are over ``shard_bytes``, queries to blocks of ``block``; each block is sent to
each shard by an equi-join on the shard's number, both as byte strings of
bounded size, and each pair gives k rows per query, which are merged by one
window. No row is broadcast, and every row is searched.

Defined cases: a vector that is null, or holds a null or non-finite component,
takes no part, neither as query nor as candidate; vectors of other lengths
count as filled up with zeros; several rows of one id count as one row with
the smallest of their vectors, a null id takes no part; equal scores go to the
smaller id; fewer than k candidates give fewer rows. Scores are 64-bit
integers.
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

HIGH, LOW = 0.75, 0.25  # quantiles that postings begin from


class Postings:
    """One shard: its vectors, and per term which rows lie beyond the baselines."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[by_id], rows[by_id]
        n, dims = rows.shape
        self.order = np.argsort(self.rows, axis=0, kind="stable")
        ranked = np.take_along_axis(self.rows, self.order, axis=0)
        self.low, self.high = ranked[int(LOW * (n - 1))], ranked[int(HIGH * (n - 1))]
        self.least, self.most = ranked[0], ranked[-1]
        self.begin_high = np.array([np.searchsorted(ranked[:, d], self.high[d], side="right") for d in range(dims)])
        self.end_low = np.array([np.searchsorted(ranked[:, d], self.low[d], side="left") for d in range(dims)])
        self.columns = np.ascontiguousarray(self.rows.T)

    def posting(self, term: int, weight: int) -> np.ndarray:
        """Rows of a term's posting, the most helpful first."""
        order = self.order[:, term]
        return order[self.begin_high[term] :][::-1] if weight > 0 else order[: self.end_low[term]]

    def search(self, query: np.ndarray, k: int, own: int) -> list[tuple[int, int]]:
        """The k best (score, id) of this shard, the row called ``own`` left out."""
        terms = np.flatnonzero(query)
        weights = query[terms]
        base = np.where(weights > 0, self.high[terms], self.low[terms])
        best = np.where(weights > 0, self.most[terms], self.least[terms])
        floor = int((weights * base).sum())  # what a row outside all postings reaches at most
        bounds = weights * (best - base)
        by_bound = np.argsort(-bounds, kind="stable")
        # A first threshold: true scores of rows that strong postings begin with.
        first = [self.posting(terms[t], weights[t])[: 4 * k] for t in by_bound[:4]]
        seeds = np.unique(np.concatenate([*first, np.arange(min(len(self.ids), 2 * k))]))
        seeds = seeds[self.ids[seeds] != own]
        scores = np.sort(self.rows[seeds] @ query)[::-1]
        threshold = int(scores[k - 1]) if len(scores) >= k else None
        candidates = np.arange(len(self.ids))
        if threshold is not None:
            # Weakest terms first: non-essential while together they stay under the threshold.
            reach = floor + np.cumsum(bounds[by_bound[::-1]])
            essential = by_bound[: len(terms) - int(np.searchsorted(reach, threshold, side="left"))]
            if floor < threshold:
                met = np.zeros(len(self.ids), bool)
                for t in essential:
                    met[self.posting(terms[t], weights[t])] = True
                candidates = np.flatnonzero(met)
        candidates = candidates[self.ids[candidates] != own]
        # Score term by term; probe on only while a row can still reach the threshold.
        rest = int((weights * best).sum())
        partial = np.zeros(len(candidates), np.int64)
        for i, t in enumerate(by_bound):
            partial += weights[t] * self.columns[terms[t]][candidates]
            rest -= int(weights[t] * best[t])
            if threshold is None or i % 4 != 3 or len(candidates) <= 4 * k:
                continue
            if i % 16 == 15:
                lead = candidates[np.argpartition(-partial, 4 * k)[: 4 * k]]
                threshold = max(threshold, int(np.sort(self.rows[lead] @ query)[-k]))
            alive = partial + rest >= threshold
            if not alive.all():
                candidates, partial = candidates[alive], partial[alive]
        top = np.lexsort((self.ids[candidates], -partial))[:k]
        return [(int(partial[i]), int(self.ids[candidates[i]])) for i in top]


def _blobs(rows: DataFrame, key: str, dims: int) -> DataFrame:
    """(key, n, ids, vectors): the rows of each key as two byte strings."""

    def gather(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        lists = table.column("v").combine_chunks()
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        values = lists.flatten().to_numpy(zero_copy_only=False)
        flat = np.zeros((len(ids), dims), np.int64)
        if len(values) == flat.size:
            flat[:] = values.reshape(flat.shape)
        else:
            for i, x in enumerate(np.split(values, ends[:-1])):
                flat[i, : len(x)] = x
        return pa.table(
            {
                key: pa.array([table.column(key)[0].as_py()], pa.int32()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "vectors": pa.array([flat.tobytes()], pa.binary()),
            }
        )

    return rows.groupBy(key).applyInArrow(gather, f"{key} int, ids binary, vectors binary")


def integer_components(vector: Column) -> Column:
    """floor(256 * x) of each component (x as double), or null where the vector takes no part."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.when(
        vector.isNotNull() & ~bad,
        F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("long")),
    )


def top_k(
    vectors: DataFrame,
    vec_id: str,
    components: Column,
    is_query: Column,
    k: int = 5,
    shard: int = 16_384,
    block: int = 2_048,
    shard_bytes: int = 16_000_000,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best other rows.

    ``components``: array<long>, null where a row takes no part; ``is_query``
    is a condition on the id column.
    """
    rows = (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), components.alias("v"), is_query.alias("q"))
        .filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"), F.max("q").alias("q"))
    )
    path = shared_dir(vectors.sparkSession, "topk")
    rows.write.parquet(path)
    rows = vectors.sparkSession.read.schema(rows.schema).parquet(path)
    n, queries, dims = rows.agg(F.count("*"), F.count_if("q"), F.max(F.size("v"))).first()
    most = max(1, shard_bytes // (8 * max(dims or 0, 1)))  # rows of a shard or a block
    shards, blocks = max(1, math.ceil(n / min(shard, most))), max(1, math.ceil(queries / min(block, most)))
    deal = lambda parts, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")
    index = _blobs(rows.select("vec_id", "v", deal(shards, 1).alias("shard")), "shard", dims or 0)
    asked = _blobs(rows.filter("q").select("vec_id", "v", deal(blocks, 2).alias("block")), "block", dims or 0)
    # Each block of queries is sent to each shard: an equi-join on the shard number.
    sent = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.col("ids").alias("q_ids"),
        F.col("vectors").alias("q_vectors"),
    )
    pairs = index.join(sent, "shard").select("shard", "ids", "vectors", "q_ids", "q_vectors")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, postings = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                number, ids, vectors, q_ids, q_vectors = (c[row].as_py() for c in batch.columns)
                if number != at:
                    own = np.frombuffer(ids, np.int64)
                    postings = Postings(own, np.frombuffer(vectors, np.int64).reshape(len(own), -1))
                    at = number
                asked = np.frombuffer(q_ids, np.int64)
                matrix = np.frombuffer(q_vectors, np.int64).reshape(len(asked), -1)
                found = [
                    (int(q), s, v) for q, x in zip(asked, matrix) for s, v in postings.search(x, k, int(q))
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1, 2)],
                    names=["query_id", "score", "vec_id"],
                )

    found = pairs.mapInArrow(search, "query_id long, score long, vec_id long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
