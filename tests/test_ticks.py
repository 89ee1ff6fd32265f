import json

from pyspark.sql import functions as F

from ohlcflow.jobs import apply_transforms
from ohlcflow.operators.ticks import (
    TICK_TRANSFORMS,
    add_ingest_time,
    fill_bar_schema,
    latest_price,
    decode_ticks,
    quote_rejects,
    unpivot_quotes,
)
from ohlcflow.schemas import SERVED_COLUMNS


def _records(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string").select(F.col("value").cast("binary").alias("value"))


def test_tick_chain_permissive(spark):
    texts = [
        json.dumps({"symbol": "A", "close": 1.5}),
        json.dumps({"symbol": "B", "close": "n/a"}),   # wrong type: null close
        json.dumps({"symbol": "C", "close": None}),
        "garbage",                                     # row of nulls, not dropped
        json.dumps({"symbol": "D", "close": 2}),       # integer price
    ]
    df = apply_transforms(_records(spark, texts), TICK_TRANSFORMS)
    assert df.columns == SERVED_COLUMNS
    rows = df.collect()
    assert len(rows) == 5
    got = sorted(((r.symbol or ""), r.close) for r in rows)
    assert got == [("", None), ("A", 1.5), ("B", None), ("C", None), ("D", 2.0)]
    # Q1: present columns keep their values, missing price columns are 0.0.
    assert all(r.high == 0.0 and r.volumeto == 0.0 and r.time is not None for r in rows)


def test_fill_schema_keeps_present_columns(spark):
    df = spark.createDataFrame([("A", 3.0, 4.0)], "symbol string, close double, high double")
    r = fill_bar_schema(df).collect()[0]
    assert (r.symbol, r.close, r.high, r.low, r.time) == ("A", 3.0, 4.0, 0.0, None)


def test_ingest_time_is_per_evaluation(spark):
    df = spark.createDataFrame([("A",)], "symbol string")
    plan = add_ingest_time(df)._jdf.queryExecution().analyzed().toString()
    assert "current_timestamp" in plan


def test_unpivot_quotes(spark):
    docs = [
        json.dumps({"A": {"USD": 1.5}, "B": {}, "C": {"EUR": 2.0}, "D": {"USD": 3}}),
        json.dumps({"Response": "Error", "Message": "x"}),
    ]
    df = spark.createDataFrame([(d,) for d in docs], "payload string")
    got = sorted((r.symbol, r.close) for r in unpivot_quotes(df).collect())
    assert got == [("A", 1.5), ("B", None), ("C", None), ("D", 3.0)]


def test_one_bad_quote_spoils_no_other(spark):
    docs = [
        json.dumps({"A": {"USD": "1.5"}, "B": {"USD": "n/a"}, "C": {"USD": 2}, "D": 5, "E": None, "F": {"USD": {"x": 1}}}),
        json.dumps({"Response": "Error", "Message": "You are over your rate limit please upgrade your account!"}),
        "<html>",
        "[1]",
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "n int, payload string")
    got = sorted((r.symbol, r.close) for r in unpivot_quotes(df).collect())
    assert got == [("A", 1.5), ("B", None), ("C", 2.0), ("D", None), ("E", None), ("F", None)]
    rejects = quote_rejects(df).collect()
    assert sorted((r.n, r.status) for r in rejects) == [(1, "rate_limited"), (2, "malformed"), (3, "malformed")]
    assert {r.payload for r in rejects} == set(docs[1:])


def test_a_tick_without_id_is_not_lost(spark):
    rows = [(None, "2024-01-01 00:00:01", 10.0), (5, "2024-01-01 00:00:02", 12.0), (None, "2024-01-01 00:00:03", 11.0)]
    t = spark.createDataFrame(rows, "id long, ts string, price double").selectExpr("id", "to_timestamp(ts) ts", "'X' symbol", "price")
    assert latest_price(t, tiebreak="id").first().close == 11.0


def test_latest_price_list_and_frame(spark):
    rows = [("A", "2024-01-01 00:00:00", 1.0, 1), ("A", "2024-01-02 00:00:00", 2.0, 2),
            ("A", "2024-01-02 00:00:00", 3.0, 3), ("B", "2024-01-01 00:00:00", 5.0, 4)]
    t = spark.createDataFrame(rows, "symbol string, ts string, price double, id long").withColumn("ts", F.to_timestamp("ts"))
    got = {r.symbol: r.close for r in latest_price(t, tiebreak="id").collect()}
    assert got == {"A": 3.0, "B": 5.0}
    assert [r.symbol for r in latest_price(t, symbols=["B"]).collect()] == ["B"]
    sym = spark.createDataFrame([("A",), ("A",)], "symbol string")
    assert [r.symbol for r in latest_price(t, symbols=sym, tiebreak="id").collect()] == ["A"]


def test_tick_json_roundtrip_stays_jvm_side(spark):
    df = decode_ticks(_records(spark, ['{"symbol":"A","close":1}']))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
