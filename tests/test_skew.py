"""Behaviour when one symbol holds a third of the rows."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from ohlcflow import fixtures
from ohlcflow.operators.bars import last_n_bars, ohlcv
from ohlcflow.plans.backfill import date_chunks
from ohlcflow.sinks import write_by_symbol

from conftest import SF_ORACLE


def _skewed_ticks(spark):
    ticks = fixtures.ticks(spark.read.parquet(f"{SF_ORACLE}/events.parquet"))
    hot = F.when(F.col("event_id") % 3 == 0, F.lit("HOT")).otherwise(F.col("symbol"))
    return ticks.withColumn("symbol", hot)


def test_hot_symbol_write_is_split(spark, scratch):
    bars = ohlcv(_skewed_ticks(spark), "1 minute", tiebreak="event_id").withColumn("batch_unit", F.lit("minutely"))
    # Small advisory size and no coalescing stand in for a cluster stage with
    # many map tasks: a skewed rebalance partition is split along map outputs.
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        write_by_symbol(bars, scratch, fmt="parquet")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = [f for f in os.listdir(f"{scratch}/symbol=HOT") if f.endswith(".parquet")]
    assert len(files) > 1                       # the hot partition went to several writers
    assert spark.read.parquet(scratch).count() == bars.count()


def test_hot_symbol_aggregations_are_partial(spark):
    ticks = _skewed_ticks(spark)
    for df in (ohlcv(ticks, "1 day"), last_n_bars(ohlcv(ticks, "1 hour"), 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "partial_" in plan or "WindowGroupLimit" in plan
    daily = ohlcv(ticks, "1 day").groupBy("symbol").agg(F.sum("volumefrom").alias("n"))
    got = {r.symbol: r.n for r in daily.collect()}
    assert got["HOT"] == ticks.where("symbol = 'HOT'").count()


def test_random_date_chunks_in_one_job(spark):
    rnd = random.Random(11)
    base = dt.date(2010, 1, 1)
    cases = []
    for i in range(400):
        s = base + dt.timedelta(days=rnd.randint(0, 5000))
        e = s + dt.timedelta(days=rnd.randint(-3, 3000))
        cases.append((i, s, e, rnd.choice([1, 2, 7, 83, 2000, rnd.randint(1, 500)])))
    df = spark.createDataFrame(cases, "i int, s date, e date, w int")
    out = {}
    for w in sorted({c[3] for c in cases}):
        part = df.where(F.col("w") == w).select("i", F.explode(date_chunks(F.col("s"), F.col("e"), w)).alias("c"))
        for r in part.collect():
            out.setdefault(r.i, []).append((r.c.chunk_no, r.c.start, r.c.end))
    one = dt.timedelta(days=1)
    for i, s, e, w in cases:
        want, k = [], 0
        while True:
            cs = s + k * w * one
            if cs + (w - 1) * one < e:
                want.append((k, cs, cs + (w - 1) * one))
                k += 1
            else:
                want.append((k, cs, e))
                break
        assert sorted(out[i]) == want, (s, e, w)


def test_last_n_above_group_limit_threshold_is_exact_and_salted(spark):
    ticks = _skewed_ticks(spark)
    bars = ohlcv(ticks, "1 minute", tiebreak="event_id")
    last = last_n_bars(bars, 1500, to_ts="2024-01-25 00:00:00", salt_buckets=6)
    got = {(r.symbol, r.time) for r in last.collect()}
    rows = [r for r in bars.where("time <= '2024-01-25 00:00:00'").select("symbol", "time").collect()]
    want = set()
    for sym in {r.symbol for r in rows}:
        times = sorted((r.time for r in rows if r.symbol == sym), reverse=True)[:1500]
        want |= {(sym, t) for t in times}
    assert got == want
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
