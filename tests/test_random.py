"""Randomized checks against brute force, each in one Spark job."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ohlcflow.operators.bars import covering_tier, covering_tier_text, dedupe_latest
from ohlcflow.operators.setops import except_all


def test_tier_text_equals_timestamp_tier(spark):
    rnd = random.Random(3)
    base = dt.datetime(2009, 1, 1)
    rows = []
    for _ in range(500):
        t = base + dt.timedelta(seconds=rnd.randint(0, 16 * 365 * 86400))
        run = (dt.date(2015, 1, 1) + dt.timedelta(days=rnd.randint(0, 3650))).isoformat()
        rows.append((t.strftime("%Y-%m-%d %H:%M:%S"), run))
    df = spark.createDataFrame(rows, "time string, run string")
    for run in sorted({r[1] for r in rows})[:25]:
        part = df.where(F.col("run") == run)
        got = part.select(
            covering_tier_text(F.col("time"), run).alias("a"), covering_tier(F.to_timestamp("time"), run).alias("b")
        ).collect()
        assert all(r.a == r.b for r in got)


def test_except_all_matches_spark_on_random_multisets(spark):
    rnd = random.Random(9)
    vals = [None, 1, 2, 3]
    left = [(rnd.choice(vals), rnd.choice(["a", None])) for _ in range(600)]
    right = [(rnd.choice(vals), rnd.choice(["a", None])) for _ in range(400)]
    a = spark.createDataFrame(left, "x int, y string")
    b = spark.createDataFrame(right, "x int, y string")
    got = sorted(map(tuple, except_all(a, b, block=7).collect()), key=str)
    want = sorted(map(tuple, a.exceptAll(b).collect()), key=str)
    assert got == want


def test_dedupe_latest_matches_python(spark):
    rnd = random.Random(21)
    rows = [(rnd.randint(0, 30), rnd.randint(0, 5), rnd.random(), rnd.randint(0, 1000)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k int, seq int, v double, w int")
    got = {r.k: (r.v, r.w) for r in dedupe_latest(df, keys=("k",), order_col="seq").collect()}
    best = {}
    for k, seq, v, w in rows:
        if k not in best or seq > best[k][0]:
            best[k] = (seq, {(v, w)})
        elif seq == best[k][0]:
            best[k][1].add((v, w))
    assert set(got) == set(best)
    for k, (_, candidates) in best.items():
        assert got[k] in candidates            # a whole row among the latest ones
