import random

import pytest
from pyspark.sql import functions as F

from ohlcflow.operators.bars import select_tier_by_ranges, tier_segments
from ohlcflow.operators.intervals import interval_join, islands, subtract
from ohlcflow.plans.backfill import backfill_plan, landed_ranges, remaining_plan

RANGE = "k string, start long, `end` long"


def ranges(rng, n, keys="ab", top=200, longest=30):
    out = []
    for _ in range(n):
        s = rng.randrange(-20, top)
        out.append((rng.choice(keys), s, s + rng.randrange(-3, longest)))
    return out


def covered(rows):
    return {(k, x) for k, s, e in rows if k is not None and s is not None and e is not None for x in range(s, e + 1)}


def as_ranges(points):
    """Maximal runs of consecutive points per key."""
    return sorted((k, x, next(y for y in range(x, 10**6) if (k, y + 1) not in points)) for k, x in points if (k, x - 1) not in points)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_islands(spark, seed, width):
    rows = ranges(random.Random(seed), 60) + [("a", None, 4), ("a", 4, None)]
    got = sorted(map(tuple, islands(spark.createDataFrame(rows, RANGE), ["k"], width).collect()))
    assert got == as_ranges(covered(rows))


@pytest.mark.parametrize("width", [1, 10, 500])
def test_interval_join(spark, width):
    rng = random.Random(width)
    left, right = ranges(rng, 50), ranges(rng, 50) + [(None, 1, 5)]
    left += left[:3] + [(None, 1, 5), ("a", None, 3)]  # repeated rows stay repeated; null keys meet nothing
    a = spark.createDataFrame(left, RANGE).withColumn("x", F.lit("l"))
    b = spark.createDataFrame(right, RANGE).withColumn("x", F.lit("r"))
    joined = interval_join(a, b, ["k"], width)
    assert joined.columns == ["k", "start", "end", "x", "right_start", "right_end", "right_x"]
    ok = [r for r in left if None not in r and r[1] <= r[2]]
    want = sorted((k, s, e, t, u) for k, s, e in ok for q, t, u in right if q == k and t <= u and t <= e and s <= u)
    assert sorted((r[0], r[1], r[2], r[4], r[5]) for r in joined.collect()) == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("seed", range(3))
def test_subtract(spark, seed):
    rng = random.Random(seed)
    want, have = ranges(rng, 20), ranges(rng, 25, longest=9)
    wanted = spark.createDataFrame([(k, s, e, n) for n, (k, s, e) in enumerate(want)], RANGE + ", id int").withColumn("note", F.lit("n"))
    got = subtract(wanted, islands(spark.createDataFrame(have, RANGE), ["k"], 16), ["k"], ["k", "id"], 16)
    assert got.columns == [*wanted.columns, "gap_start", "gap_end"]
    held = covered(have)
    expect = []
    for n, (k, s, e) in enumerate(want):
        expect += [(n, a, b) for _, a, b in as_ranges({(k, x) for x in range(s, e + 1)} - held)]
    assert sorted((r["id"], r["gap_start"], r["gap_end"]) for r in got.collect()) == sorted(expect)


def test_remaining_plan(spark):
    """Whole requests stay, landed ones go, gaps become requests for whole bars."""
    plan = backfill_plan(spark.createDataFrame([("A",), ("B",)], "symbol string"), "2022-03-20", ranges=True).cache()
    keep = plan.drop("start", "end", "bar_seconds").columns
    hours = plan.where("symbol = 'A' AND batch_unit = 'hourly'").orderBy("chunk_no").collect()
    first, second = hours[0], hours[1]
    landed = [
        ("A", "hourly", first["start"], first["end"] - 100 * 3600),     # two overlapping deliveries
        ("A", "hourly", first["end"] - 150 * 3600, first["end"]),
        ("A", "hourly", second["start"] + 5 * 3600, second["start"] + 9 * 3600 - 1),
        ("A", "hourly", second["end"] - 1799, second["end"]),           # half a bar is none
        ("C", "daily", 0, 10**10),
    ]
    got = remaining_plan(plan, spark.createDataFrame(landed, "symbol string, batch_unit string, start long, `end` long"))
    rows = {(r.symbol, r.batch_unit, r.chunk_no, r.part_no): r for r in got.collect()}
    whole = {(r.symbol, r.batch_unit, r.chunk_no, 0): r for r in plan.collect()}
    touched = [("A", "hourly", n, 0) for n in (first.chunk_no, second.chunk_no)]
    for key, r in whole.items():
        if key not in touched:
            assert [rows[key][c] for c in keep] == [r[c] for c in keep]
    assert touched[0] not in rows and len(rows) == len(whole) - 2 + 2
    a, b = rows[touched[1]], rows[(*touched[1][:3], 1)]
    assert (a.toTs, a.limit) == (second["start"] + 4 * 3600, 5)
    bars = (second["end"] + 1 - second["start"]) // 3600
    # The last bar has landed by half: it is not in the gap as a whole.
    assert (b.toTs, b.limit) == (second["end"] + 1 - 2 * 3600, bars - 9 - 1)
    assert remaining_plan(plan, spark.createDataFrame([], "symbol string, batch_unit string, start long, `end` long")).count() == len(whole)


def test_landed_ranges(spark):
    rows = [("A", "hourly", "2024-01-01 05:00:00"), ("A", "minutely", "2024-01-01 05:01:00"), ("A", "weekly", "2024-01-01 05:00:00"), ("A", "daily", None), ("A", "daily", "n/a")]
    got = landed_ranges(spark.createDataFrame(rows, "symbol string, batch_unit string, time string")).collect()
    assert sorted((r.batch_unit, r.start, r.end) for r in got) == [("hourly", 1704085200, 1704088799), ("minutely", 1704085260, 1704085319)]


@pytest.mark.parametrize("seed", range(3))
def test_tiers_by_ranges(spark, seed):
    rng = random.Random(seed)
    units = ["daily", "hourly", "minutely", "weekly"]
    rows = [(rng.choice("XYZ"), rng.choice(units), s, s + rng.randrange(-5, 400)) for s in (rng.randrange(1000) for _ in range(25))]
    rows += [(None, "daily", 0, 2000), ("X", "daily", None, 5), ("X", None, 0, 5)]
    frame = spark.createDataFrame(rows, "symbol string, batch_unit string, start long, `end` long")

    def finest(symbol, t):
        over = [units.index(u) for s, u, a, b in rows if s == symbol and u in units[:3] and a is not None and a <= t <= b]
        return units[max(over)] if over else None

    cover = tier_segments(frame, 50).collect()
    got = {}
    for r in cover:
        for t in range(r.start, r.end + 1):
            assert got.setdefault((r.symbol, t), r.batch_unit) == r.batch_unit
    assert got == {(s, t): finest(s, t) for s in "XYZ" for t in range(1500) if finest(s, t)}
    bars = [(s, u, t) for s in "XYZ" for u in units for t in range(0, 1500, 7)]
    df = spark.createDataFrame(bars, "symbol string, batch_unit string, t long")
    df = df.select("symbol", "batch_unit", F.date_format(F.timestamp_seconds("t"), "yyyy-MM-dd HH:mm:ss").alias("time"), F.col("t").alias("close"))
    kept = select_tier_by_ranges(df, frame, 60)
    assert kept.columns == df.columns
    assert sorted((r.symbol, r.batch_unit, r.close) for r in kept.collect()) == sorted(b for b in bars if finest(b[0], b[2]) == b[1])
