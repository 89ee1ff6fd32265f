import datetime as dt

import pytest
from pyspark.sql import functions as F

from ohlcflow.plans.backfill import backfill_plan, date_chunks, second_chunks


def _brute_chunks(start, end, width, one):
    """Closed contiguous chunks of ``width``; the last one ends at ``end``."""
    out, k = [], 0
    while True:
        cs = start + k * width * one
        ce = cs + (width - 1) * one
        if ce < end:
            out.append((k, cs, ce))
            k += 1
        else:
            out.append((k, cs, end))
            return out


CASES = [
    ("2024-01-01", "2024-01-31", 10),   # 31 days in chunks of 10: 4 chunks, last clipped
    ("2024-01-01", "2024-01-30", 10),   # exact division
    ("2024-01-01", "2024-01-01", 83),   # start = end
    ("2024-01-05", "2024-01-01", 7),    # start after end: one chunk as given
    ("2010-07-17", "2015-03-20", 2000),
    ("2015-03-21", "2022-03-13", 83),
]


@pytest.mark.parametrize("s,e,w", CASES)
def test_date_chunks_match_brute_force(spark, s, e, w):
    df = spark.range(1).select(F.explode(date_chunks(F.to_date(F.lit(s)), F.to_date(F.lit(e)), w)).alias("c"))
    got = [(r.c.chunk_no, r.c.start, r.c.end) for r in df.collect()]
    want = _brute_chunks(dt.date.fromisoformat(s), dt.date.fromisoformat(e), w, dt.timedelta(days=1))
    assert got == want


@pytest.mark.parametrize("s,e,w", [(0, 599999, 120000), (0, 600000, 120000), (10, 10, 5), (0, 2, 1), (0, 1, 2)])
def test_second_chunks_match_brute_force(spark, s, e, w):
    df = spark.range(1).select(F.explode(second_chunks(F.lit(s).cast("long"), F.lit(e).cast("long"), w)).alias("c"))
    got = [(r.c.chunk_no, r.c.start, r.c.end) for r in df.collect()]
    assert got == _brute_chunks(s, e, w, 1)


def _epoch(d):
    return int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.timezone.utc).timestamp())


def test_backfill_plan_reference_mode(spark):
    sym = spark.createDataFrame([("A",), ("B",)], "symbol string")
    plan = backfill_plan(sym, "2022-03-20")
    rows = plan.where("symbol = 'A'").orderBy("batch_unit", "chunk_no").collect()
    daily = [r for r in rows if r.batch_unit == "daily"]
    hourly = [r for r in rows if r.batch_unit == "hourly"]
    minutely = [r for r in rows if r.batch_unit == "minutely"]
    want_daily = _brute_chunks(dt.date(2010, 7, 17), dt.date(2015, 3, 20), 2000, dt.timedelta(days=1))
    assert [(r.toTs, r.limit) for r in daily] == [(_epoch(ce), (ce - cs).days) for _, cs, ce in want_daily]
    want_hourly = _brute_chunks(dt.date(2015, 3, 21), dt.date(2022, 3, 13), 83, dt.timedelta(days=1))
    assert [(r.toTs, r.limit) for r in hourly] == [(_epoch(ce), (ce - cs).days * 24) for _, cs, ce in want_hourly]
    m0 = _epoch(dt.date(2022, 3, 14))
    want_min = _brute_chunks(m0, _epoch(dt.date(2022, 3, 20)), 120000, 1)
    assert [(r.toTs, r.limit) for r in minutely] == [(cs, 2000) for _, cs, _ in want_min]   # Q6: chunk start
    assert {r.endpoint for r in daily} == {"histoday"} and {r.tsym for r in rows} == {"USD"}
    assert plan.count() == 2 * len(rows)
    # Built by generators: no join, no shuffle.
    phys = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in phys and "Exchange" not in phys


def test_backfill_plan_aligned_mode(spark):
    sym = spark.createDataFrame([("A",)], "symbol string")
    rows = backfill_plan(sym, "2022-03-20", mode="aligned").where("batch_unit = 'minutely'").orderBy("chunk_no").collect()
    assert rows[0].toTs == _epoch(dt.date(2022, 3, 14)) + 120000 - 1
    assert rows[0].limit == 2000


@pytest.mark.parametrize("run_date,daily_end", [
    ("2022-03-31", "2015-03-31"),
    ("2024-02-29", "2017-02-28"),   # leap day clamps once (Q7)
    ("2022-05-31", "2015-05-31"),   # a single-month chain would fail on April 31
    ("2022-03-29", "2015-03-29"),
])
def test_edge_run_dates(spark, run_date, daily_end):
    sym = spark.createDataFrame([("A",)], "symbol string")
    rows = backfill_plan(sym, run_date).where("batch_unit = 'daily'").orderBy(F.desc("chunk_no")).collect()
    assert rows[0].toTs == _epoch(dt.date.fromisoformat(daily_end))


def test_unknown_mode(spark):
    sym = spark.createDataFrame([("A",)], "symbol string")
    with pytest.raises(ValueError):
        backfill_plan(sym, "2022-03-20", mode="nope")
