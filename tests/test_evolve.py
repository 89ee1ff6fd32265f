import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ohlcflow.session import schema_versions, table_columns
from ohlcflow.sinks import SchemaConflict, merge_bars
from ohlcflow.sinks.evolve import common_schema, conform, evolve
from ohlcflow.sources import read_bar_table

# Types are parsed by a session.
pytestmark = pytest.mark.usefixtures("spark")

BARS = "time string, high double, low double, open double, close double, volumefrom double, volumeto double, symbol string, batch_unit string, ingest_seq long"


def schema(text):
    return T._parse_datatype_string(text)


@pytest.mark.parametrize(
    "old, new, both",
    [
        ("a int", "a long", "a long"),
        ("a long", "a smallint", "a long"),
        ("a double", "a int", "a double"),
        ("a double", "a long", "a double"),
        ("a int", "a double", "a double"),
        ("a int", "a float", "a double"),
        ("a float", "a double", "a double"),
        ("a double", "a decimal(10,2)", "a double"),
        ("a int", "a decimal(10,2)", "a decimal(12,2)"),
        ("a decimal(10,2)", "a decimal(12,4)", "a decimal(12,4)"),
        ("a decimal(10,2)", "a int", "a decimal(12,2)"),
        ("a date", "a timestamp_ntz", "a timestamp_ntz"),
        ("a timestamp_ntz", "a date", "a timestamp_ntz"),
        ("a int", "b string", "a int, b string"),
        ("A int", "a long, B int", "A long, B int"),
        ("s struct<x:int>", "s struct<y:string,X:long>", "s struct<x:bigint,y:string>"),
        ("s array<struct<x:int>>", "s array<struct<x:int,y:date>>", "s array<struct<x:int,y:date>>"),
        ("m map<string,int>", "m map<string,long>", "m map<string,bigint>"),
        ("a void", "a string", "a string"),
        ("a string", "a void", "a string"),
    ],
)
def test_common_schema(old, new, both):
    assert common_schema(schema(old), schema(new)).simpleString() == schema(both).simpleString()


@pytest.mark.parametrize(
    "old, new",
    [
        ("a long", "a double"), ("a double", "a string"), ("a string", "a int"), ("a date", "a timestamp"),
        ("a decimal(10,2)", "a double"), ("a int", "a struct<x:int>"), ("a decimal(38,0)", "a decimal(38,10)"),
        ("s struct<x:long>", "s struct<x:double>"), ("a int", "b int, B int"), ("m map<string,int>", "m map<int,int>"),
    ],
)
def test_conflicts_are_refused(old, new):
    with pytest.raises(SchemaConflict):
        common_schema(schema(old), schema(new))


def test_widened_files_read_as_they_are(spark, scratch):
    """Every widening the rules allow is one that the reader makes of older files."""
    first = "i int, l long, f float, d date, n decimal(8,2), s struct<x:int>, a array<struct<x:int>>"
    then = "i double, l decimal(22,2), f double, d timestamp_ntz, n decimal(12,4), s struct<x:long,y:string>, a array<struct<x:long,y:int>>"
    rows = [(1, 2, 0.5, None, None, (3,), [(4,), (5,)]), (None, None, None, None, None, None, None)]
    old = spark.createDataFrame(rows, first).withColumn("n", F.lit("1.25").cast("decimal(8,2)"))
    old = old.withColumn("d", F.lit("2024-01-02").cast("date"))
    old.write.parquet(scratch)
    wide = common_schema(old.schema, schema(then))
    new = spark.createDataFrame([(1.5,)], "i double")
    conform(new, wide).write.mode("append").parquet(scratch)
    got = spark.read.schema(wide).parquet(scratch).orderBy(F.col("i").desc_nulls_last()).collect()
    assert got[0].i == 1.5 and got[0].s is None
    assert got[1].i == 1.0 and got[1].l == 2 and str(got[1].n) == "1.2500" and str(got[1].d) == "2024-01-02 00:00:00"
    assert (got[1].s.x, got[1].s.y) == (3, None) and [(x.x, x.y) for x in got[1].a] == [(4, None), (5, None)]


def test_versions_are_kept_once(spark, scratch):
    a, b = schema("x int"), schema("x int, y string")
    assert table_columns(spark, scratch) is None
    assert evolve(spark, scratch, a, a) == a and evolve(spark, scratch, a, a) == a
    assert len(schema_versions(spark, scratch)) == 1
    assert evolve(spark, scratch, schema("y string"), a) == b == table_columns(spark, scratch)
    assert evolve(spark, scratch, schema("x smallint"), a) == b
    assert schema_versions(spark, scratch) == ["000001.json", "000002.json"]
    with pytest.raises(SchemaConflict):
        evolve(spark, scratch, schema("x string"), a)
    assert len(schema_versions(spark, scratch)) == 2


def test_concurrent_versions(spark, scratch, monkeypatch):
    """A writer that finds its version taken starts over from the other's columns."""
    from ohlcflow.sinks import evolve as module

    first = schema("x int")
    evolve(spark, scratch, first, first)
    put, calls = module.create_file, []

    def late(spark, path, text):
        calls.append(path)
        if len(calls) == 1:  # another writer was quicker
            assert put(spark, path, schema("x int, theirs string").json())
        return put(spark, path, text)

    monkeypatch.setattr(module, "create_file", late)
    both = evolve(spark, scratch, schema("x long, ours date"), first)
    assert both.simpleString() == "struct<x:bigint,theirs:string,ours:date>" and len(calls) == 2


def _bar(symbol, time, close, seq):
    return (time, 1.0, 1.0, 1.0, close, 1.0, 1.0, symbol, "daily", seq)


def test_increments_bring_columns(spark, scratch):
    day = "2024-01-0{} 00:00:00".format
    merge_bars(spark.createDataFrame([_bar("A", day(1), 1.0, 1), _bar("B", day(1), 1.0, 1)], BARS), scratch)
    more = spark.createDataFrame([_bar("A", day(2), 2.0, 2)], BARS)
    merge_bars(more.withColumns({"venue": F.lit("X"), "close": F.lit(7), "n": F.lit(3)}), scratch)
    merge_bars(spark.createDataFrame([_bar("A", day(3), 3.0, 3)], BARS).withColumn("n", F.lit(5_000_000_000)), scratch)
    got = {(r.symbol, r.time[:10]): (r.close, r.venue, r.n) for r in read_bar_table(spark, scratch).collect()}
    assert got == {
        ("A", "2024-01-01"): (1.0, None, None), ("A", "2024-01-02"): (7.0, "X", 3),
        ("A", "2024-01-03"): (3.0, None, 5_000_000_000), ("B", "2024-01-01"): (1.0, None, None),
    }
    with pytest.raises(SchemaConflict):
        merge_bars(more.withColumn("close", F.lit("text")), scratch)
    assert read_bar_table(spark, scratch).count() == 4
    # Scans of other columns do not read the new ones.
    plan = read_bar_table(spark, scratch).select("close")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<close:double>" in plan


PART = BARS + ", part string, open_key decimal(38,0), close_key decimal(38,0)"


def _part(part, seq, values, keys, time="2024-01-01 00:00:00"):
    high, low, open_, close, qty, amount = values
    return (time, high, low, open_, close, qty, amount, "A", "daily", seq, part, *keys)


def test_partial_bars_add_up(spark, scratch):
    from decimal import Decimal as D

    def put(*rows):
        merge_bars(spark.createDataFrame(list(rows), PART), scratch)

    def bar():
        r = read_bar_table(spark, scratch).where("time = '2024-01-01 00:00:00'").first()
        return (r.high, r.low, r.open, r.close, r.volumefrom, r.volumeto, [p.part for p in r.parts or []])

    late = _part("late", 0, (9.0, 2.0, 3.0, 4.0, 2.0, 7.0), (D(30), D(40)))
    early = _part("early", 0, (8.0, 1.0, 5.0, 6.0, 1.0, 5.0), (D(10), D(20)))
    grown = _part("early", 1, (8.0, 0.5, 5.0, 7.0, 3.0, 9.0), (D(10), D(25)))
    put(late)
    assert bar() == (9.0, 2.0, 3.0, 4.0, 2.0, 7.0, ["late"])
    put(early)
    assert bar() == (9.0, 1.0, 5.0, 4.0, 3.0, 12.0, ["early", "late"])
    for _ in range(2):  # a grown part replaces itself; coming again changes nothing
        put(grown, early)
        assert bar() == (9.0, 0.5, 5.0, 4.0, 5.0, 16.0, ["early", "late"])
    put(_part("late", 0, (9.0, 2.0, 3.0, 4.0, 2.0, 7.0), (D(30), D(40))), _part("x", 0, (1.0,) * 6, (D(1), D(1)), "2024-01-02 00:00:00"))
    assert bar()[:4] == (9.0, 0.5, 5.0, 4.0) and read_bar_table(spark, scratch).count() == 2
    # The source's own bar shows; parts that come later change nothing of it.
    merge_bars(spark.createDataFrame([("2024-01-01 00:00:00", 50.0, 40.0, 41.0, None, 1.0, 1.0, "A", "daily", 5)], BARS), scratch)
    put(_part("more", 3, (99.0, 0.0, 1.0, 1.0, 1.0, 1.0), (D(1), D(99))))
    assert bar() == (50.0, 40.0, 41.0, None, 1.0, 1.0, [None, "early", "late", "more"])
    merge_bars(spark.createDataFrame([_bar("A", "2024-01-01 00:00:00", 8.0, 4)], BARS), scratch)  # an older version
    assert bar()[0] == 50.0


def test_parts_equal_one_aggregation(spark):
    """Bars of any division of the ticks, put together, are the bars of all ticks."""
    import random

    from ohlcflow.operators.bars import merge_partial_bars, ohlcv

    rng = random.Random(1)
    rows = [(i, f"2024-01-01 {rng.randrange(4):02d}:{rng.randrange(3):02d}:00", rng.choice("AB"), float(rng.randint(1, 9)), rng.randrange(3)) for i in range(300)]
    ticks = spark.createDataFrame(rows, "event_id long, t string, symbol string, price double, who int").withColumn("ts", F.to_timestamp("t"))
    whole = ohlcv(ticks, "1 hour", tiebreak="event_id", order_keys=True)
    parts = [ohlcv(ticks.where(f"who = {k}"), "1 hour", tiebreak="event_id", order_keys=True) for k in range(3)]
    merged = merge_partial_bars(parts[0].union(parts[1]).union(parts[2]), ["symbol", "time"]).select(*whole.columns)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
