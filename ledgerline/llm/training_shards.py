"""Token ids in training order: fixed-stride binary shards.

Every document is encoded, closed with the end token and cut into sequences of
``length`` ids (the last one is filled up). Sequences are numbered in the order
of the input: a document reserves as many numbers as its bytes could need at
most, which is known without encoding. A keyed Feistel permutation of all
reserved numbers turns the number into a ticket: its bits are split into two
halves that mix each other over ``ROUNDS`` rounds, and a result outside the
domain is put through again (cycle-walking) until it falls inside. The order of
the tickets is the training order, and a sequence's place in it is its global
slot. The permutation can be computed, and inverted, from the key alone.

``tickets`` tickets in a row make a shard: one range, one partition and one
file, sorted by ticket. A record has a fixed stride (``record_type``: ticket,
document, piece, number of ids, the ids as 16-bit integers, and a two-byte
mark), so the sizes of the files tell the first slot of each shard, and a
reader goes on from any slot by seeking to ``(slot - first) * stride``. Spark's
committer writes the files, so a lost task or executor leaves no half shard.

How the work is spread: one pass sums the reserved numbers of each input split
(sizes only), a second one encodes, and each sequence is moved once, by its
ticket. Both passes read the same splits; the check after the write (every
ticket larger than the one before it) would tell if they had not.

Defined cases: a null or empty text is one sequence holding the end token
only; a null id is marked in the record; repeated rows are sequences of their
own; an empty table writes no shard and gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.tokenizer import VOCABULARY, Encoder, read_vocabulary
from ledgerline.session import shared_dir

END_TOKEN = 50256  # the free id of the vocabulary
MARK = b"\n\n"
ROUNDS = 6
NO_ID = 1  # flag of a record whose document has no id


def record_type(length: int) -> np.dtype:
    return np.dtype(
        [
            ("ticket", "<i8"),
            ("doc_id", "<i8"),
            ("piece", "<i4"),
            ("n_tokens", "<u2"),
            ("flags", "<u2"),
            ("ids", "<u2", (length,)),
            ("mark", "S2"),
        ]
    )


# ------------------------------------------------------------------ permutation


def _mix(x: np.ndarray) -> np.ndarray:
    """A public 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(key: int) -> list[np.uint64]:
    return [_mix(np.array([(key + 1 + i) * 0x9E3779B97F4A7C15 & (2**64 - 1)], np.uint64))[0] for i in range(ROUNDS)]


def _feistel(x: np.ndarray, half: int, keys) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for k in keys:
        left, right = right, left ^ (_mix(right ^ k) & mask)
    return left << np.uint64(half) | right


def _unfeistel(x: np.ndarray, half: int, keys) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    for k in reversed(keys):
        left, right = right ^ (_mix(left ^ k) & mask), left
    return left << np.uint64(half) | right


def permute(x: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The tickets of the numbers ``x`` in 0..n-1 (or back)."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    step, keys = (_unfeistel if inverse else _feistel), _keys(key)
    x = step(np.asarray(x).astype(np.uint64), half, keys)
    while (out := x >= np.uint64(n)).any():
        x[out] = step(x[out], half, keys)
    return x.astype(np.int64)


# ------------------------------------------------------------------ writing


def write_shards(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = 256,
    tickets: int = 65_536,
    key: int = 20_011,
    vocabulary: str = VOCABULARY,
) -> int:
    """Write the shards below ``path``; returns the number of tickets (0: nothing to write).

    ``docs`` must be read from stored tables (both passes read it).
    """
    vocab, kind = read_vocabulary(vocabulary), record_type(length)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.spark_partition_id().alias("split")
    )

    reserved = F.ceil((F.coalesce(F.octet_length("text"), F.lit(0)) + 1) / F.lit(length))
    # One row per input split: the first number of each.
    counted = sorted(tuple(r) for r in rows.groupBy("split").agg(F.sum(reserved)).collect())
    first, n = {}, 0
    for split, m in counted:
        first[split], n = n, n + m
    if not n:
        return 0

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = Encoder(vocab).ids, None
        for b in batches:
            if not b.num_rows:
                continue
            if number is None:
                number = first[b.column(2)[0].as_py()]
            out = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = encode(t)
                n_ids = len(ids) + 1  # with the end token
                own = np.zeros(-(-n_ids // length), kind)
                own["doc_id"], own["flags"] = d or 0, NO_ID if d is None else 0
                own["piece"] = np.arange(len(own))
                own["ticket"] = number + own["piece"]
                number += -(-(len((t or "").encode()) + 1) // length)
                own["n_tokens"] = length
                own["n_tokens"][-1] = n_ids - length * (len(own) - 1)
                flat = np.zeros(len(own) * length, "<u2")
                flat[: n_ids - 1], flat[n_ids - 1] = ids, END_TOKEN
                own["ids"] = flat.reshape(len(own), length)
                out.append(own)
            records = np.concatenate(out)
            records["mark"] = MARK
            records["ticket"] = permute(records["ticket"], n, key)
            stride = kind.itemsize - len(MARK)  # the writer ends each record with the mark
            raw = records.view(np.uint8).reshape(len(records), kind.itemsize)[:, :stride]
            blob = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(stride), len(records), [None, pa.py_buffer(np.ascontiguousarray(raw))]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(records["ticket"]), blob.cast(pa.binary())], names=["ticket", "record"]
            )

    records = rows.mapInArrow(encode, "ticket long, record binary")
    (
        records.repartitionById(-(-n // tickets), F.floor(F.col("ticket") / tickets).cast("int"))
        .sortWithinPartitions("ticket")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", MARK.decode())
        .text(path)
    )
    return n


# ------------------------------------------------------------------ reading


READ = (
    "slot long, ticket long, doc_id long, piece int, n_tokens int, file string, offset long, "
    "ids_crc32 long, ids array<int>"
)


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)


def first_slots(spark: SparkSession, path: str, length: int = 256) -> dict[str, int]:
    """The first slot of each shard, from the sizes of the files (one row per shard)."""
    stride = record_type(length).itemsize
    sizes = sorted(
        (r["path"].rpartition("/")[2], r["length"])
        for r in shard_files(spark, path).select("path", "length").collect()
    )
    first, n = {}, 0
    for name, size in sizes:
        if size % stride:
            raise RuntimeError(f"{name} is not a whole number of records")
        first[name], n = n, n + size // stride
    return first


def read_records(spark: SparkSession, path: str, length: int = 256) -> DataFrame:
    """Each record of the shards below ``path`` with its slot and place (``READ``).

    Raises where a ticket is not larger than the one before it in its shard.
    """
    kind, first = record_type(length), first_slots(spark, path, length)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for b in batches:
            for where, content in zip(b.column(0), b.column(1)):
                name = where.as_py().rpartition("/")[2]
                records = np.frombuffer(content.as_buffer(), kind)
                if (np.diff(records["ticket"]) <= 0).any():
                    raise ValueError(f"{name}: tickets are not in order")
                for lo in range(0, len(records), 4096):
                    part = records[lo : lo + 4096]
                    place = np.arange(lo, lo + len(part))
                    lengths = part["n_tokens"].astype(np.int64)
                    inside = np.arange(length)[None, :] < lengths[:, None]
                    crc = [zlib.crc32(r[:k].tobytes()) for r, k in zip(part["ids"], lengths)]
                    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(first[name] + place),
                            pa.array(part["ticket"]),
                            pa.array(part["doc_id"], mask=part["flags"] == NO_ID),
                            pa.array(part["piece"]),
                            pa.array(lengths.astype(np.int32)),
                            pa.array([name] * len(part), pa.string()),
                            pa.array(place * kind.itemsize),
                            pa.array(crc, pa.int64()),
                            pa.ListArray.from_arrays(ends, part["ids"][inside].astype(np.int32)),
                        ],
                        names=[f.split()[0] for f in READ.split(", ")],
                    )

    return shard_files(spark, path).select("path", "content").mapInArrow(parse, READ)


def resume(path: str, slot: int, length: int = 256) -> Iterator[np.ndarray]:
    """Records from ``slot`` on, in training order, read sequentially (a trainer's view).

    For a folder that this process can open; records come as ``record_type``.
    """
    import os

    kind = record_type(length)
    for name in sorted(f for f in os.listdir(path) if f.startswith("part-")):
        own = os.path.getsize(os.path.join(path, name)) // kind.itemsize
        if slot < own:
            with open(os.path.join(path, name), "rb") as f:
                f.seek(slot * kind.itemsize)
                while raw := f.read(kind.itemsize * 1024):
                    yield from np.frombuffer(raw, kind)
        slot = max(0, slot - own)


def materialise(docs: DataFrame, path: str | None = None, length: int = 256, **options) -> DataFrame:
    """Write the shards and return one row per record as read back (``READ``)."""
    spark = docs.sparkSession
    path = path or shared_dir(spark, "shards")
    if not write_shards(docs, path, length=length, **options):
        return spark.createDataFrame([], READ)
    return read_records(spark, path, length)
