"""Hard negatives against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import hard_negatives
from ledgerline.llm.hard_negatives import SortedLists, mine, window_of
from ledgerline.llm.topk import integer_components

SCHEMA = "vec_id long, embedding array<float>, label int, shard string, score string, anchor_id string, rank string"


def _brute(rows, positives=5, negatives=10):
    one = {}
    for i, v, label in rows:
        bad = i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v)
        if not bad:
            c = tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)
            one[i] = min(one.get(i, (label, c)), (label, c))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = Counter()
    for a, (label, q) in one.items():
        if a % 3:
            continue
        scored = sorted((-dot(q, c), i, o) for i, (o, c) in one.items() if i != a)
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [s for s in scored if s[2] != label and 30 * -ps <= 100 * -s[0] <= 90 * -ps]
            for rank, (ns, n, _) in enumerate(inside[:negatives], 1):
                out[(a, p, rank, n, -ps, -ns)] += 1
    return out


def _rows(seed, n=150, dims=6):
    r = random.Random(seed)
    vec = lambda: [round(r.gauss(0.2, 0.5), 1) for _ in range(dims)]  # noqa: E731  many ties
    rows = [(i, vec(), r.choice([1, 1, 2, 3])) for i in range(n)]
    rows += [(i, rows[0][1], 2) for i in range(n, n + 30)]  # a group of copies
    rows += [(900, None, 1), (901, [None] * dims, 1), (902, [float("nan")] * dims, 1), (903, [float("inf")] * dims, 2)]
    rows += [(904, vec(), None), (None, vec(), 1), (905, [0.0] * dims, 1), (906, vec()[:3], 2), (907, [], 3), (909, vec(), 77)]
    return rows + [rows[3], (rows[4][0], vec(), 2)]  # a repeated row, two rows of one id


def _mine(spark, rows, **more):
    df = spark.createDataFrame([(*x, "a", "b", "c", "d") for x in rows], SCHEMA).repartition(3)
    found = mine(df, "vec_id", F.col("label"), integer_components(F.col("embedding")), F.col("vec_id") % 3 == 0, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in found.collect())


@pytest.mark.parametrize("seed,shard,block", [(1, 16_384, 2048), (2, 20, 7)])
def test_against_brute_force(spark, monkeypatch, seed, shard, block):
    monkeypatch.setattr(hard_negatives, "STRETCH", 2)  # shipped to the tasks by value
    rows = _rows(seed)
    got = _mine(spark, rows, shard=shard, block=block)
    assert got == _brute(rows) and len(got) > 100


def test_empty_tables(spark):
    assert not _mine(spark, [])
    assert not _mine(spark, [(3, [0.5], 1)])
    assert not _mine(spark, [(3, None, 1), (4, None, None)])


def test_reading_stops_early_and_ties_are_met():
    r = np.random.default_rng(1)
    rows = r.integers(-9, 9, (4000, 8))
    rows[:3] = 1000  # far above the rest
    lists = SortedLists(np.arange(4000), np.zeros(4000, np.int64), rows)
    read = []
    lists.order = type("Order", (), {"__getitem__": lambda self, key, o=lists.order: read.append(key[1]) or o[key]})()
    query = np.ones(8, np.int64)
    (best,) = lists.search(query, -1, 0, True, [(None, None)], 3)
    assert best == [(8000, 0), (8000, 1), (8000, 2)]
    assert max(s.stop - s.start for s in read) < 100


def test_large_components_are_counted_exactly():
    rows = np.array([[2**62, 2**62], [2**62, -(2**62)], [3, 4]])
    lists = SortedLists(np.arange(3), np.zeros(3, np.int64), rows)
    (best,) = lists.search(np.array([2**40, 1]), -1, 0, True, [(None, None)], 3)
    assert best == [(2**102 + 2**62, 0), (2**102 - 2**62, 1), (3 * 2**40 + 4, 2)]


def test_windows_are_exact_integers():
    for p in [*range(-50, 400), 2**60 + 1]:
        low, high = window_of(p, (30, 100), (90, 100))
        near = {*range(low - 2, low + 3), *range(high - 2, high + 3)}
        assert {s for s in near if 30 * p <= 100 * s <= 90 * p} == {s for s in near if low <= s <= high}
