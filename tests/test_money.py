"""Exact rounding of the money helpers against Python's Decimal arithmetic."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from ledgerline.functions.money import avg_money, half_up_ratio, safe_growth


def _rows(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        total = Decimal(rng.randint(0, 10**13)) / 100
        count = rng.choice([1, 2, 3, 4, 7, 8, 16, 1000, rng.randint(1, 10**6)])
        rows.append((total, count))
    # exact half-cent averages: 1.01 / 2 = 0.505, 0.03 / 2 = 0.015
    rows += [(Decimal("1.01"), 2), (Decimal("0.03"), 2), (Decimal("0.05"), 10), (Decimal("0"), 3)]
    return rows


def test_avg_money_is_half_up_of_the_exact_quotient(spark):
    rows = _rows(1)
    df = spark.createDataFrame(rows, "total decimal(33,2), n bigint")
    got = [r[0] for r in df.select(avg_money("total", "n")).collect()]
    want = [float((t / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for t, n in rows]
    assert got == want


def test_ratio_is_half_up_away_from_zero(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(400):
        a = Decimal(rng.randint(-10**12, 10**12)) / 100
        b = Decimal(rng.choice([1, -1]) * rng.randint(1, 10**12)) / 100
        rows.append((a, b))
    rows += [(Decimal("1"), Decimal("8000000")), (Decimal("-1"), Decimal("8000000")), (Decimal("5"), Decimal("0"))]
    df = spark.createDataFrame(rows, "a decimal(33,2), b decimal(33,2)")
    got = [r[0] for r in df.select(half_up_ratio("a", "b", 6)).collect()]
    want = [
        None if b == 0 else float((a / b).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP))
        for a, b in rows
    ]
    assert got == want


def test_growth_is_zero_without_a_base(spark):
    df = spark.createDataFrame(
        [(Decimal("10"), None), (Decimal("10"), Decimal("0")), (Decimal("15"), Decimal("10"))],
        "cur decimal(33,2), prev decimal(33,2)",
    )
    assert [r[0] for r in df.select(safe_growth("cur", "prev")).collect()] == [0.0, 0.0, 0.5]
