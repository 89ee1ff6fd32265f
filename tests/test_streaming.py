import json
import os

from pyspark.sql import functions as F

from ohlcflow import fixtures
from ohlcflow.sources import read_tick_stream
from ohlcflow.streaming import (
    ohlcv_stream,
    read_latest_bars,
    read_sink,
    start_bar_upserts,
    start_quote_producer,
    start_tick_consumer,
    tick_stream,
)
from ohlcflow.jobs import apply_transforms
from ohlcflow.operators.ticks import TICK_TRANSFORMS

from conftest import SF_SMALL


def test_tick_stream_equals_batch_and_rerun_adds_nothing(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    records = fixtures.tick_records(ev)
    src, sink, ckpt = f"{scratch}/src", f"{scratch}/sink", f"{scratch}/ckpt"
    records.repartitionByRange(4, "ts").write.parquet(src)
    stream = read_tick_stream(spark, fmt="parquet", path=src, max_files_per_trigger=1)
    q = start_tick_consumer(tick_stream(stream), sink, ckpt, fmt="parquet")
    q.awaitTermination()
    out = read_sink(spark, sink)
    assert out.select("run", "batch_id").distinct().count() == 4     # one file per trigger
    files = [f for _, _, names in os.walk(sink) for f in names if f.endswith(".parquet")]
    assert len(files) <= 4 * (out.select("symbol").distinct().count() + 1)
    batch = apply_transforms(records.select("value"), TICK_TRANSFORMS)
    cols = ["symbol", "close", "high", "volumeto"]
    assert sorted(map(tuple, out.select(cols).collect()), key=str) == sorted(map(tuple, batch.select(cols).collect()), key=str)
    # Restart with the same checkpoint: nothing new.
    q2 = start_tick_consumer(tick_stream(read_tick_stream(spark, fmt="parquet", path=src)), sink, ckpt, fmt="parquet")
    q2.awaitTermination()
    assert read_sink(spark, sink).count() == out.count() == ev.count()


def test_bar_stream_upserts(spark, scratch):
    rows = [(1, "2024-01-01 00:10:00", "X", 10.0), (2, "2024-01-01 00:40:00", "X", 12.0)]
    later = [(3, "2024-01-01 00:50:00", "X", 7.0), (4, "2024-01-01 03:00:00", "X", 1.0)]
    schema = "event_id long, ts string, symbol string, price double"
    src, sink = f"{scratch}/src", f"{scratch}/sink"
    for chunk in (rows, later):
        spark.createDataFrame(chunk, schema).withColumn("ts", F.to_timestamp("ts")).write.mode("append").parquet(src)
        s = spark.readStream.schema("event_id long, ts timestamp, symbol string, price double").parquet(src)
        start_bar_upserts(ohlcv_stream(s, "1 hour", "2 hours", tiebreak="event_id"), sink, f"{sink}-ckpt").awaitTermination()
    got = {r.time: (r.open, r.high, r.low, r.close) for r in read_latest_bars(spark, sink).collect()}
    assert got == {"2024-01-01 00:00:00": (10.0, 12.0, 7.0, 7.0), "2024-01-01 03:00:00": (1.0, 1.0, 1.0, 1.0)}
    from ohlcflow.streaming import compact_bar_sink
    from ohlcflow.sources import read_bar_table

    compact_bar_sink(spark, sink, f"{scratch}/table", "hourly")
    compact_bar_sink(spark, sink, f"{scratch}/table", "hourly")          # rerun-safe
    table = read_bar_table(spark, f"{scratch}/table")
    assert table.count() == 2 and {r.batch_unit for r in table.collect()} == {"hourly"}


def test_quote_producer(spark, scratch):
    qdir, out = f"{scratch}/quotes", f"{scratch}/out"
    os.makedirs(qdir)
    with open(f"{qdir}/q1.json", "w") as f:
        f.write(json.dumps({"A": {"USD": 1.5}, "B": {"EUR": 1.0}}) + "\n")
        f.write(json.dumps({"Response": "Error", "Message": "x"}) + "\n")
    q = start_quote_producer(spark, qdir, out, f"{scratch}/ckpt", trigger="availableNow")
    q.awaitTermination()
    vals = sorted((json.loads(r.value)["symbol"], json.loads(r.value).get("close")) for r in spark.read.json(out).collect())
    assert vals == [("A", 1.5), ("B", None)]


def test_dedupe_stream_within_and_across_batches(spark, scratch):
    from ohlcflow.streaming import dedupe_stream

    schema = "event_id long, ts string, value string"
    first = [(1, "2024-01-01 00:00:00", '{"symbol":"A","close":1}'), (1, "2024-01-01 00:00:00", '{"symbol":"A","close":1}'),
             (2, "2024-01-01 00:30:00", '{"symbol":"B","close":2}')]
    second = [(2, "2024-01-01 00:30:00", '{"symbol":"B","close":2}'), (3, "2024-01-01 00:40:00", '{"symbol":"C","close":3}')]
    src, sink = f"{scratch}/src", f"{scratch}/sink"
    for rows in (first, second):
        (spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts"))
         .withColumn("value", F.col("value").cast("binary")).write.mode("append").parquet(src))
        s = spark.readStream.schema("event_id long, ts timestamp, value binary").parquet(src)
        start_tick_consumer(tick_stream(dedupe_stream(s, ["event_id"], "ts", "1 hour")), sink, f"{sink}-ckpt",
                            fmt="parquet").awaitTermination()
    got = sorted(r.symbol for r in read_sink(spark, sink).collect())
    assert got == ["A", "B", "C"]


def test_late_rows_are_counted(spark, scratch):
    from ohlcflow.streaming import dedupe_stream, dropped_as_late

    schema = "event_id long, ts string, value string"
    src, sink, late = f"{scratch}/src", f"{scratch}/sink", []
    for n, hour in enumerate(("10", "20", "11")):
        row = [(n, f"2024-01-01 {hour}:00:00", '{"symbol":"A","close":1}')]
        (spark.createDataFrame(row, schema).withColumn("ts", F.to_timestamp("ts"))
         .withColumn("value", F.col("value").cast("binary")).write.mode("append").parquet(src))
        s = spark.readStream.schema("event_id long, ts timestamp, value binary").parquet(src)
        q = start_tick_consumer(tick_stream(dedupe_stream(s, ["event_id"], "ts", "1 hour")), sink, f"{sink}-ckpt", fmt="parquet")
        q.awaitTermination()
        late.append(dropped_as_late(q))
    assert late == [0, 0, 1] and read_sink(spark, sink).count() == 2


def test_bar_stream_append_emits_closed_bars_once(spark, scratch):
    schema = "event_id long, ts string, symbol string, price double"
    batches = [
        [(1, "2024-01-01 00:10:00", "X", 10.0), (2, "2024-01-01 00:40:00", "X", 12.0)],
        [(3, "2024-01-01 03:30:00", "X", 7.0)],           # moves the watermark past hour 0
        [(4, "2024-01-01 06:30:00", "X", 5.0)],           # and past hour 3
    ]
    src, sink = f"{scratch}/src", f"{scratch}/sink"
    for rows in batches:
        spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts")).write.mode("append").parquet(src)
        s = spark.readStream.schema("event_id long, ts timestamp, symbol string, price double").parquet(src)
        start_bar_upserts(ohlcv_stream(s, "1 hour", "1 hour", tiebreak="event_id"), sink, f"{sink}-ckpt",
                          output_mode="append").awaitTermination()
    out = spark.read.parquet(sink)
    got = sorted((r.time, r.open, r.close) for r in out.collect())
    # Hour 6 is still open (watermark 05:30); hours 0 and 3 are written exactly once.
    assert got == [("2024-01-01 00:00:00", 10.0, 12.0), ("2024-01-01 03:00:00", 7.0, 7.0)]


def test_two_queries_make_one_bar(spark, scratch):
    """A bar whose ticks two checkpoints have seen: the sink's reader and the table add them up."""
    from ohlcflow.sources import read_bar_table
    from ohlcflow.streaming import compact_bar_sink

    schema = "event_id long, ts timestamp, symbol string, price double"
    halves = [[(i, f"2024-01-01 00:{6 * i:02d}:00", "X", float(i)) for i in part] for part in (range(5), range(5, 10))]
    sink, table = f"{scratch}/sink", f"{scratch}/table"
    compact_bar_sink(spark, f"{scratch}/nothing", table, "hourly")       # no batch yet: nothing
    for n, rows in enumerate(halves):
        src = f"{scratch}/src{n}"
        spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn("ts", F.to_timestamp("ts")).write.parquet(src)
        s = spark.readStream.schema(schema).parquet(src)
        start_bar_upserts(ohlcv_stream(s, "1 hour", "2 hours", tiebreak="event_id"), sink, f"{scratch}/ckpt{n}").awaitTermination()
        compact_bar_sink(spark, sink, table, "hourly")
    want = [("X", 9.0, 0.0, 0.0, 9.0, 10.0, 45.0)]
    cols = ["symbol", "high", "low", "open", "close", "volumefrom", "volumeto"]
    assert [tuple(r) for r in read_latest_bars(spark, sink).select(cols).collect()] == want
    assert [tuple(r) for r in read_bar_table(spark, table).select(cols).collect()] == want
    assert len(read_bar_table(spark, table).first().parts) == 2


def test_a_named_part_replaces_itself(spark, scratch):
    from ohlcflow.sources import read_bar_table
    from ohlcflow.streaming import compact_bar_sink

    schema = "event_id long, ts timestamp, symbol string, price double"
    src, table = f"{scratch}/src", f"{scratch}/table"
    rows = [(i, f"2024-01-01 00:{6 * i:02d}:00", "X", float(i)) for i in range(5)]
    spark.createDataFrame(rows, schema.replace("timestamp", "string")).withColumn("ts", F.to_timestamp("ts")).write.parquet(src)
    for n in range(2):  # the same ticks under two checkpoints
        s = spark.readStream.schema(schema).parquet(src)
        sink = f"{scratch}/sink{n}"
        start_bar_upserts(ohlcv_stream(s, "1 hour", "2 hours", tiebreak="event_id"), sink, f"{scratch}/ckpt{n}").awaitTermination()
        compact_bar_sink(spark, sink, table, "hourly", part="ticks")
    assert [r.volumefrom for r in read_bar_table(spark, table).collect()] == [5.0]


def _feed(spark, src, rows, schema="event_id long, ts string, symbol string, price double"):
    spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(src)
    return spark.readStream.schema(schema.replace("ts string", "ts timestamp")).parquet(src)


def test_latest_price_state(spark, scratch):
    """Restarts, ticks out of order, ties, late ticks, symbols that expire and come back."""
    from ohlcflow.streaming import latest_price_stream, read_latest_prices, start_latest_prices

    src, sink = f"{scratch}/src", f"{scratch}/sink"

    def run(*rows):
        stream = _feed(spark, src, list(rows))
        latest = latest_price_stream(stream, "1 hour", 6 * 3600, tiebreak="event_id")
        start_latest_prices(latest, sink, f"{scratch}/ckpt").awaitTermination()
        return {r.symbol: (r.close, r.time[8:16], r.expired) for r in read_latest_prices(spark, sink).collect()}

    assert read_latest_prices(spark, sink).count() == 0
    day = "2024-01-01 {}:00".format
    got = run((1, day("10:00"), "A", 1.0), (2, day("10:00"), "A", 2.0), (3, day("09:30"), "A", 9.0), (4, day("10:00"), "B", 5.0),
              (5, None, "A", 7.0), (6, day("10:00"), None, 7.0))
    assert got == {"A": (2.0, "01 10:00", False), "B": (5.0, "01 10:00", False)}
    # After a restart: an older tick within the watermark changes nothing, a newer one does; a null price is one.
    got = run((7, day("09:50"), "A", 3.0), (8, day("12:00"), "B", None))
    assert got == {"A": (2.0, "01 10:00", False), "B": (None, "01 12:00", False)}
    # The watermark (17:30) passes 16:00: A expires; B lasts until 18:00.
    got = run((9, day("18:30"), "C", 1.0))
    assert got == {"A": (2.0, "01 10:00", True), "B": (None, "01 12:00", False), "C": (1.0, "01 18:30", False)}
    # Behind the watermark: cannot bring A back. A new tick can.
    got = run((10, day("16:30"), "A", 4.0))
    assert got["A"] == (2.0, "01 10:00", True)
    got = run((11, day("18:00"), "A", 6.0), (12, day("19:00"), "C", 8.0))
    assert got == {"A": (6.0, "01 18:00", False), "B": (None, "01 12:00", True), "C": (8.0, "01 19:00", False)}


def test_enrichment_reads_the_dimension_per_batch(spark, scratch):
    from ohlcflow.jobs import bind
    from ohlcflow.operators.enrich import with_dimension

    src, sink, dim = f"{scratch}/src", f"{scratch}/sink", f"{scratch}/dim"
    for n, rows in enumerate(([("A", 1), ("A", 3), (None, 9)], [("A", 7), ("B", 2)])):
        spark.createDataFrame(rows, "symbol string, rank int").write.mode("overwrite").parquet(dim)
        stream = _feed(spark, src, [(n, "2024-01-01 00:00:00", "A", 1.0), (n, "2024-01-01 00:00:00", "B", 1.0), (n, "2024-01-01 00:00:00", None, 1.0)])
        start_tick_consumer(stream, sink, f"{scratch}/ckpt", fmt="parquet", enrichments=(bind(with_dimension, dim, ["rank"]),), by=()).awaitTermination()
    got = {(r.event_id, r.symbol): r["rank"] for r in spark.read.parquet(sink).collect()}
    assert got == {(0, "A"): 3, (0, "B"): None, (0, None): None, (1, "A"): 7, (1, "B"): 2, (1, None): None}
    import pytest

    with pytest.raises(ValueError):
        with_dimension(spark.createDataFrame([("A", 1)], "symbol string, rank int"), dim, ["rank"])


def test_checked_stream(spark, scratch):
    """Every record once, served or rejected; a replayed start adds nothing; whole texts are kept."""
    from ohlcflow.streaming import read_checked, start_checked_consumer

    texts = ['{"symbol":"A","close":1.5}', '{"symbol":"A","close":"2.5"}', '{"symbol":"A"}', '{"symbol":"A","close":null}',
             '{"symbol":"A","close":"n/a"}', '{"symbol":"B","close":{"x":1}}', '{"close":1}', "not json", "", "[1]", "null", None, "é{"]
    src, sink = f"{scratch}/src", f"{scratch}/sink"
    assert read_checked(spark, sink).count() == 0 == read_checked(spark, sink, rejects=True).count()
    rows = spark.createDataFrame([(t,) for t in texts], "value string").withColumn("value", F.col("value").cast("binary"))
    rows.write.parquet(src)
    for _ in range(2):
        stream = spark.readStream.schema("value binary").parquet(src)
        start_checked_consumer(stream, sink, f"{scratch}/ckpt").awaitTermination()
    good = read_checked(spark, sink)
    assert sorted(((r.symbol, r.close) for r in good.collect()), key=str) == sorted([("A", 1.5), ("A", 2.5), ("A", None), ("A", None)], key=str)
    assert {r.time is not None and r.high == 0.0 for r in good.collect()} == {True} and "payload" not in good.columns
    bad = sorted(((r.status, r.payload) for r in read_checked(spark, sink, rejects=True).collect()), key=str)
    want = [("bad_price", texts[4]), ("bad_price", texts[5]), ("no_symbol", texts[6])] + [("malformed", t) for t in texts[7:]]
    assert bad == sorted(want, key=str)
