import json

from pyspark.sql import functions as F

from ohlcflow.jobs import apply_transforms
from ohlcflow.operators.bars import (
    BAR_TRANSFORMS,
    dedupe_latest,
    last_n_bars,
    ohlcv,
    resample_bars,
    select_tier,
    union_tiers,
)
from ohlcflow.operators.quality import accept, classify, quarantine
from ohlcflow.schemas import BAR_COLUMNS, RATE_LIMIT_MESSAGE
from ohlcflow.sources.files import parse_payloads


def _payload(bars, response="Success", message=""):
    return json.dumps({"Response": response, "Message": message, "Data": {"Data": bars}})


BAR = {"time": 1647734400, "high": 2.0, "low": 1.0, "open": 1.5, "close": 1.8, "volumefrom": 10, "volumeto": 18.0}


def _frame(spark, rows):
    return spark.createDataFrame(rows, "symbol string, batch_unit string, payload string")


def test_payload_chain_variants(spark):
    rows = [
        ("A", "daily", _payload([BAR, {**BAR, "time": 1647820800, "high": "n/a"}])),
        ("B", "daily", _payload([])),                       # empty array: no rows
        ("C", "daily", json.dumps({"Response": "Success", "Data": None})),  # null Data
        ("D", "daily", _payload([{**BAR, "extra": 1}])),     # extra field ignored
        ("E", "daily", _payload([BAR], "Error", RATE_LIMIT_MESSAGE)),
        ("F", "daily", "not json"),
    ]
    df = apply_transforms(accept(parse_payloads(_frame(spark, rows))), BAR_TRANSFORMS)
    assert df.columns == BAR_COLUMNS + ["symbol", "batch_unit"]
    got = sorted((r.symbol, r.time, r.high, r.volumefrom) for r in df.collect())
    # The string "n/a" cannot be a double: PERMISSIVE parsing keeps the bar, high is null.
    assert got == [
        ("A", "2022-03-20 00:00:00", 2.0, 10.0),
        ("A", "2022-03-21 00:00:00", None, 10.0),
        ("D", "2022-03-20 00:00:00", 2.0, 10.0),
    ]


def test_numbers_as_text(spark):
    text = {k: str(v) for k, v in BAR.items()}
    odd = {**BAR, "time": "soon", "high": {"x": 1}, "low": None, "open": True}
    df = apply_transforms(accept(parse_payloads(_frame(spark, [("A", "daily", _payload([BAR, text, odd]))]))), BAR_TRANSFORMS)
    plain, same, broken = df.collect()
    assert plain == same and plain.high == 2.0 and plain.time == "2022-03-20 00:00:00"
    assert (broken.time, broken.high, broken.low, broken.open, broken.close) == (None, None, None, None, 1.8)


def test_null_ties_and_orders(spark):
    rows = [(None, "2024-01-01 00:00:01", 10.0), (1, "2024-01-01 00:10:00", 12.0)]
    t = spark.createDataFrame(rows, "id long, ts string, price double").selectExpr("id", "to_timestamp(ts) ts", "'X' symbol", "price")
    assert ohlcv(t, "1 hour", tiebreak="id").first().open == 10.0
    d = spark.createDataFrame([("A", 1, None), ("A", 2, None), ("B", 3, 7), ("B", 4, None)], "symbol string, v int, seq long")
    got = {r.symbol: r.v for r in dedupe_latest(d, keys=("symbol",), order_col="seq").collect()}
    assert got["B"] == 3 and got["A"] in (1, 2)


def test_tiers_do_not_mix(spark):
    rows = [("A", u, f"2024-01-01 0{h}:00:00", 1.0) for u in ("daily", "hourly") for h in range(4)]
    bars = spark.createDataFrame(rows, "symbol string, batch_unit string, time string, close double")
    got = sorted((r.batch_unit, r.time[11:13]) for r in last_n_bars(bars, 2).collect())
    assert got == [("daily", "02"), ("daily", "03"), ("hourly", "02"), ("hourly", "03")]


def test_quarantine_classes(spark):
    rows = [
        ("A", "daily", _payload([BAR])),
        ("B", "daily", _payload([], "Error", RATE_LIMIT_MESSAGE)),
        ("C", "daily", _payload([], "Error", "boom")),
        ("D", "daily", json.dumps({"Message": "no status"})),
        ("E", "daily", "garbage"),
    ]
    p = parse_payloads(_frame(spark, rows))
    got = {r.symbol: r.status for r in classify(p).collect()}
    assert got == {"A": "accepted", "B": "rate_limited", "C": "other", "D": "other", "E": "malformed"}
    assert accept(p).count() + quarantine(p).count() == 5
    # Lenient (quote) check: only an explicit Error is rejected.
    assert sorted(r.symbol for r in accept(p, lenient=True).collect()) == ["A", "D", "E"]


def _ticks(spark):
    rows = [
        (1, "2024-01-01 00:10:00", "X", 10.0),
        (2, "2024-01-01 00:50:00", "X", 12.0),
        (3, "2024-01-01 00:20:00", "X", 8.0),
        (4, "2024-01-01 01:05:00", "X", 9.0),
        (5, "2024-01-01 01:05:00", "X", 11.0),  # same time as 4: event id breaks the tie
        (6, "2024-01-01 00:00:00", "Y", 1.0),
    ]
    return spark.createDataFrame(rows, "event_id long, ts string, symbol string, price double").withColumn(
        "ts", F.to_timestamp("ts")
    )


def test_ohlcv_and_resample(spark):
    bars = ohlcv(_ticks(spark), "1 hour", tiebreak="event_id")
    got = {(r.symbol, r.time): (r.open, r.high, r.low, r.close, r.volumefrom, r.volumeto) for r in bars.collect()}
    assert got[("X", "2024-01-01 00:00:00")] == (10.0, 12.0, 8.0, 12.0, 3.0, 30.0)
    assert got[("X", "2024-01-01 01:00:00")] == (9.0, 11.0, 9.0, 11.0, 2.0, 20.0)
    assert got[("Y", "2024-01-01 00:00:00")] == (1.0, 1.0, 1.0, 1.0, 1.0, 1.0)
    day = {r.symbol: r for r in resample_bars(bars, "1 day").collect()}
    assert (day["X"].open, day["X"].high, day["X"].low, day["X"].close, day["X"].volumefrom) == (10.0, 12.0, 8.0, 11.0, 5.0)
    # The aggregation stays hash-based (packed ordering key), with a partial step.
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_last_n_bars_uses_group_limit(spark):
    bars = ohlcv(_ticks(spark), "10 minutes", tiebreak="event_id")
    last = last_n_bars(bars, 2, to_ts="2024-01-01 00:55:00")
    got = sorted((r.symbol, r.time) for r in last.collect())
    assert got == [("X", "2024-01-01 00:20:00"), ("X", "2024-01-01 00:50:00"), ("Y", "2024-01-01 00:00:00")]
    assert "WindowGroupLimit" in last._jdf.queryExecution().executedPlan().toString()


def test_union_and_select_tier(spark):
    ticks = _ticks(spark)
    h = ohlcv(ticks, "1 hour").withColumn("batch_unit", F.lit("hourly"))
    m = ohlcv(ticks, "1 minute").withColumn("batch_unit", F.lit("minutely"))
    u = union_tiers(h, m)
    assert u.count() == h.count() + m.count()
    # Run date 2024-01-05: hourly covers up to 2023-12-29, minutely 2023-12-30 .. 2024-01-05 00:00.
    sel = select_tier(u, "2024-01-05")
    assert {r.batch_unit for r in sel.collect()} == {"minutely"}
    sel2 = select_tier(u, "2024-01-10")
    assert {r.batch_unit for r in sel2.collect()} == {"hourly"}


def test_dedupe_latest_keeps_whole_rows(spark):
    rows = [
        ("A", "daily", "t1", 1.0, 10.0, 1),
        ("A", "daily", "t1", 2.0, 20.0, 2),
        ("A", "daily", "t2", 3.0, 30.0, 1),
        ("A", "daily", "t2", 4.0, 40.0, 1),  # tie on ingest: one whole row is kept
    ]
    df = spark.createDataFrame(rows, "symbol string, batch_unit string, time string, open double, close double, ingest_seq int")
    got = {r.time: (r.open, r.close) for r in dedupe_latest(df).collect()}
    assert got["t1"] == (2.0, 20.0)
    assert got["t2"] in {(3.0, 30.0), (4.0, 40.0)}


def test_text_and_timestamp_tier_agree(spark):
    from ohlcflow.operators.bars import covering_tier, covering_tier_text

    times = ["2010-07-16 23:59:59", "2010-07-17 00:00:00", "2017-01-28 23:59:59", "2017-01-29 00:00:00",
             "2024-01-21 23:59:59", "2024-01-22 00:00:00", "2024-01-28 00:00:00", "2024-01-28 00:00:01"]
    df = spark.createDataFrame([(t,) for t in times], "time string")
    rows = df.select(
        covering_tier_text(F.col("time"), "2024-01-28").alias("a"),
        covering_tier(F.to_timestamp("time"), "2024-01-28").alias("b"),
    ).collect()
    assert [r.a for r in rows] == [r.b for r in rows] == [
        None, "daily", "daily", "hourly", "hourly", "minutely", "minutely", None]
