import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from provenant.operators import temporal
from provenant.operators.temporal import LEVELS, applicable, stretches


def pairs(intervals, points):
    return sorted((k, p, v) for k, v, a, b in intervals for j, p, at in points if j == k and a is not None and a <= at and (b is None or at < b))


@pytest.mark.parametrize("kind", ["long", "date", "timestamp", "int"])
def test_equals_all_pairs(spark, kind):
    rng = random.Random(len(kind))
    span = 10**12 if kind == "long" else 400
    base = date(2020, 1, 1) if kind == "date" else datetime(2020, 1, 1)
    t = (lambda n: n - 200) if kind in ("long", "int") else lambda n: base + timedelta(days=n if kind == "date" else 0, seconds=0 if kind == "date" else n, microseconds=0 if kind == "date" else n % 7)
    intervals = []
    for v in range(150):
        a = rng.randrange(-span // 4, span)
        b = rng.choice([None, a - 3, a, a + 1, a + rng.randrange(span), a + rng.randrange(1, 9), 3 * span])
        intervals.append((rng.randrange(4), v, t(a), None if b is None else t(b)))
    intervals.append((1, 999, None, t(5)))
    points = [(rng.randrange(5), p, t(rng.randrange(span))) for p in range(200)]
    found = applicable(spark.createDataFrame(intervals, f"k int, v int, start {kind}, end {kind}"), spark.createDataFrame(points, f"k int, p int, at {kind}"), ["k"])
    assert sorted((r.k, r.p, r.v) for r in found.collect()) == pairs(intervals, points)


def test_stretches_make_up_their_range(spark):
    rng = random.Random(3)
    ranges = [(a, a + rng.randrange(1, 70_000 - a)) for a in (rng.randrange(60_000) for _ in range(200))] + [(0, 1), (0, 1 << LEVELS), (7, 8), (1, (1 << LEVELS) - 1), (5, 5)]
    for r in spark.createDataFrame(ranges, "a long, b long").select("a", "b", stretches(F.col("a"), F.col("b")).alias("s")).collect():
        units = sorted(u for s in r.s for u in (s.no << s.level, ((s.no + 1) << s.level) - 1))
        covered = sorted((s.no << s.level, (s.no + 1) << s.level) for s in r.s)
        assert all(x[1] == y[0] for x, y in zip(covered, covered[1:], strict=False)) and len(r.s) <= 2 * LEVELS
        assert (covered[0][0], covered[-1][1]) == (r.a, r.b) if r.a < r.b else not units


def test_a_key_of_ten_thousand_intervals_and_points(spark, monkeypatch):
    """All of one key: what the join makes is what holds, and a little at the ends of intervals."""
    n = 10_000
    intervals = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("v"), (F.col("id") * 1000).alias("start"), (F.col("id") * 1000 + 2500).alias("end"))
    points = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("p"), (F.col("id") * 997 + 13).alias("at"))
    found = applicable(intervals, points, ["k"])
    got = found.select("p", "v").collect()
    want = {(p, v) for p in range(n) for v in range(max(0, (p * 997 + 13 - 2500) // 1000), min(n - 1, (p * 997 + 13) // 1000) + 1) if v * 1000 <= p * 997 + 13 < v * 1000 + 2500}
    assert {(r.p, r.v) for r in got} == want and len(got) == len(want) < 30_000
    plan = found._jdf.queryExecution().toString()
    assert "_level" in plan and "_no" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_empty_tables_and_open_intervals(spark):
    intervals = spark.createDataFrame([(1, 5, 0, None), (1, 6, 0, 3), (2, 7, 100, None)], "k int, v int, start long, end long")
    points = spark.createDataFrame([(1, 1, 2), (1, 2, 3), (2, 3, 50), (1, 4, None)], "k int, p int, at long")
    assert sorted((r.p, r.v) for r in applicable(intervals, points, ["k"]).collect()) == [(1, 5), (1, 6), (2, 5)]
    assert applicable(intervals.limit(0), points, ["k"]).count() == applicable(intervals, points.limit(0), ["k"]).count() == applicable(intervals, points.filter("at is null"), ["k"]).count() == 0
    assert temporal.LEVELS == 16
