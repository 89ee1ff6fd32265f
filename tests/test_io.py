import json
import os
import time

import pytest
from pyspark.sql import functions as F

from ohlcflow import fixtures
from ohlcflow.jobs import Job, apply_transforms, bind, run_stages
from ohlcflow.operators.bars import BAR_TRANSFORMS
from ohlcflow.operators.quality import accept
from ohlcflow.sinks import land_payloads, merge_bars, write_by_symbol, write_documents, write_ticks
from ohlcflow.sources import read_bar_table, read_payloads, read_quarantine, read_raw, read_symbols

from conftest import SF_SMALL


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_land_and_read_payloads(spark, scratch):
    ev = _events(spark)
    payloads = fixtures.bar_payloads(ev, chunk_size=200)
    land_payloads(payloads, scratch)
    (delivery,) = os.listdir(scratch)
    assert delivery.startswith("delivery=") and os.path.isdir(f"{scratch}/{delivery}/symbol=click/batch_unit=minutely")
    # Files go by series, not by request.
    files = [f for _, _, names in os.walk(scratch) for f in names if f.endswith(".parquet")]
    assert len(files) < payloads.count() / 2
    raw = read_payloads(spark, scratch)
    assert {"symbol", "batch_unit", "request", "ingest_seq", "Response", "Data"} <= set(raw.columns)
    bars = apply_transforms(accept(raw), BAR_TRANSFORMS)
    assert bars.count() == ev.where("event_type <> 'error'").count()
    # Landing requests again, or other requests of a symbol, leaves the rest alone.
    land_payloads(payloads.where("symbol = 'click'"), scratch)
    land_payloads(payloads.where("symbol = 'click' and chunk_no = 1").selectExpr("symbol", "batch_unit", "99 AS chunk_no", "payload"), scratch)
    assert read_payloads(spark, scratch).count() == payloads.count() + 1
    assert read_raw(spark, f"{scratch}-nothing").count() == 0


BARS = "time string, high double, low double, open double, close double, volumefrom double, volumeto double, symbol string, batch_unit string, ingest_seq long"


def _bar(symbol, time, close, seq, unit="daily"):
    return (time, 1.0, 1.0, 1.0, close, 1.0, 1.0, symbol, unit, seq)


def test_bar_table_merges(spark, scratch):
    put = lambda *rows: merge_bars(spark.createDataFrame(list(rows), BARS), scratch)
    have = lambda: sorted((r.symbol, r.time[:10], r.close) for r in read_bar_table(spark, scratch).collect())
    put(_bar("007", "2023-12-31 00:00:00", 1.0, 1), _bar("007", "2024-01-01 00:00:00", 2.0, 1), _bar("B", "2024-01-01 00:00:00", 3.0, 1))
    # An increment adds, a later version replaces, an earlier one does not.
    put(_bar("007", "2024-01-02 00:00:00", 4.0, 2), _bar("007", "2024-01-01 00:00:00", 5.0, 2), _bar("B", "2024-01-01 00:00:00", 9.0, 0))
    want = [("007", "2023-12-31", 1.0), ("007", "2024-01-01", 5.0), ("007", "2024-01-02", 4.0), ("B", "2024-01-01", 3.0)]
    assert have() == want
    put(_bar("007", "2024-01-02 00:00:00", 4.0, 2))
    assert have() == want
    one = read_symbols(spark, scratch, ["007"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "007" in plan
    assert {r.symbol for r in one.collect()} == {"007"}


def test_only_touched_partitions_are_written(spark, scratch):
    merge_bars(spark.createDataFrame([_bar("A", "2023-01-01 00:00:00", 1.0, 1), _bar("B", "2023-01-01 00:00:00", 1.0, 1)], BARS), scratch)
    before = sorted(os.listdir(f"{scratch}/symbol=B/batch_unit=daily/year=2023"))
    merge_bars(spark.createDataFrame([_bar("A", "2023-01-02 00:00:00", 1.0, 2)], BARS), scratch)
    assert sorted(os.listdir(f"{scratch}/symbol=B/batch_unit=daily/year=2023")) == before


def test_document_and_symbol_sinks(spark, scratch):
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("A", 3.0)], "symbol string, close double")
    write_documents(df, f"{scratch}/docs")
    assert spark.read.json(f"{scratch}/docs").count() == 3
    write_by_symbol(df, f"{scratch}/by")
    assert sorted(p for p in os.listdir(f"{scratch}/by") if p.startswith("symbol=")) == ["symbol=A", "symbol=B"]
    got = spark.read.json(f"{scratch}/by/symbol=A")
    assert "symbol" not in got.columns and got.count() == 2
    write_ticks(df, f"{scratch}/ticks", fmt="text")
    vals = sorted(json.loads(r.value)["close"] for r in spark.read.text(f"{scratch}/ticks").collect())
    assert vals == [1.0, 2.0, 3.0]


def test_job_api(spark, scratch):
    out = f"{scratch}/job"
    doubled = bind(lambda d, k: d.withColumn("x", F.col("id") * k), 2)
    job = Job(
        read=lambda s: s.range(5),
        transforms=(lambda d: d.where("id > 0"),),
        enrichments=(doubled,),
        write=lambda d: d.write.parquet(out),
    )
    assert sorted(r.x for r in job.build(spark).collect()) == [2, 4, 6, 8]
    run_stages(spark, [job])
    assert spark.read.parquet(out).count() == 4


def test_cli_batch_and_plan(spark, scratch):
    from ohlcflow.cli import main

    ev = _events(spark)
    raw = f"{scratch}/raw"
    land_payloads(fixtures.bar_payloads(ev), raw)
    main(["batch", "--raw", raw, "--table", f"{scratch}/bars", "--out", f"{scratch}/docs"])
    main(["batch", "--raw", raw, "--table", f"{scratch}/bars", "--out", f"{scratch}/docs", "--quarantine", f"{scratch}/bad"])
    assert spark.read.json(f"{scratch}/docs").count() == ev.where("event_type <> 'error'").count()
    assert read_quarantine(spark, f"{scratch}/bad").count() == 1
    spark.createDataFrame([("A",), ("B",)], "symbol string").write.parquet(f"{scratch}/sym")
    main(["plan", "--symbols-table", f"{scratch}/sym", "--run-date", "2022-03-20", "--out", f"{scratch}/plan"])
    assert spark.read.parquet(f"{scratch}/plan").where("symbol = 'A'").count() * 2 == spark.read.parquet(f"{scratch}/plan").count()


def test_bar_table_schema_evolution(spark, scratch):
    v1 = spark.createDataFrame([("t1", 1.0, "7", "daily")], "time string, close double, symbol string, batch_unit string")
    v2 = spark.createDataFrame([("t2", 2.0, 5.0, "B", "daily")], "time string, close double, vwap double, symbol string, batch_unit string")
    for v in (v1, v2):
        v.write.mode("append").partitionBy("symbol", "batch_unit").parquet(scratch)
    got = {r.symbol: r.vwap for r in read_bar_table(spark, scratch, merge_schema=True).collect()}
    assert got == {"7": None, "B": 5.0}


def test_e1_keeps_the_later_of_overlapping_requests(spark, scratch):
    from ohlcflow.apps import raw_to_bar_table

    bar = {"time": 1647734400, "high": 2.0, "low": 1.0, "open": 1.5, "close": 1.8, "volumefrom": 1.0, "volumeto": 1.8}
    doc = lambda b: json.dumps({"Response": "Success", "Message": "", "Data": {"Data": [b]}})
    schema = "symbol string, batch_unit string, chunk_no int, payload string"
    land_payloads(spark.createDataFrame([("A", "daily", 0, doc(bar))], schema), f"{scratch}/raw")
    time.sleep(1.1)                                            # file times may be whole seconds
    land_payloads(spark.createDataFrame([("A", "daily", 1, doc({**bar, "close": 9.0}))], schema), f"{scratch}/raw")
    raw_to_bar_table(f"{scratch}/raw", f"{scratch}/bars").run(spark)
    assert [r.close for r in read_bar_table(spark, f"{scratch}/bars").collect()] == [9.0]


def test_quarantine_keeps_the_documents(spark, scratch):
    from ohlcflow.apps import raw_to_bar_table

    docs = ["<html>", json.dumps({"Response": "Error", "Message": "boom"}), json.dumps({"Message": "no status"})]
    rows = [("A", "daily", i, d) for i, d in enumerate(docs)]
    land_payloads(spark.createDataFrame(rows, "symbol string, batch_unit string, chunk_no int, payload string"), f"{scratch}/raw")
    for _ in range(2):
        raw_to_bar_table(f"{scratch}/raw", f"{scratch}/bars", f"{scratch}/bad").run(spark)
    got = read_quarantine(spark, f"{scratch}/bad").collect()
    assert sorted((r.status, r.payload) for r in got) == sorted([("malformed", docs[0]), ("other", docs[1]), ("other", docs[2])])
    assert {(r.symbol, r.batch_unit) for r in got} == {("A", "daily")} and {r.request for r in got} == {"0", "1", "2"}


def test_a_request_that_lands_again_is_replaced(spark, scratch):
    land = lambda *rows: land_payloads(spark.createDataFrame(list(rows), "symbol string, batch_unit string, chunk_no int, payload string"), scratch)
    land(("A", "daily", 0, "old ü"), ("A", "daily", 1, "kept"), ("B", "daily", 0, "other"), ("A", None, 7, "no tier"))
    time.sleep(1.1)                                            # file times may be whole seconds
    land(("A", "daily", 0, "new ü"), ("A", None, 7, "no tier, again"))
    got = sorted((r.symbol, r.request, r.payload) for r in read_raw(spark, scratch).collect())
    assert got == [("A", "0", "new ü"), ("A", "1", "kept"), ("A", "7", "no tier, again"), ("B", "0", "other")]
    for rest in ([("A", "daily", 5, "x"), ("B", "daily", 6, "y")], [("A", "daily", 5, "z")]):
        land_payloads(spark.createDataFrame(rest, "symbol string, batch_unit string, chunk_no int, payload string"), scratch, delivery="named")
    assert {(r.request, r.payload) for r in read_raw(spark, scratch).collect()} >= {("5", "z")}
    assert not [r for r in read_raw(spark, scratch).collect() if r.request == "6"]
    assert "BroadcastHashJoin" in read_raw(spark, scratch)._jdf.queryExecution().executedPlan().toString()


def test_folders_of_one_document_each(spark, scratch):
    """How other collectors land: one object per request."""
    for request, text in (("0", "{}"), ("1", "é")):
        os.makedirs(f"{scratch}/symbol=007/batch_unit=daily/request={request}")
        with open(f"{scratch}/symbol=007/batch_unit=daily/request={request}/0.json", "w") as f:
            f.write(text)
    got = sorted((r.symbol, r.batch_unit, r.request, r.payload) for r in read_raw(spark, scratch, "folders").collect())
    assert got == [("007", "daily", "0", "{}"), ("007", "daily", "1", "é")]
    with pytest.raises(ValueError):
        read_raw(spark, scratch, "other")


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from ohlcflow import session

    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())


def test_read_coin_info(spark, scratch):
    from ohlcflow.sources import read_coin_info

    os.makedirs(scratch)
    with open(f"{scratch}/info.json", "w") as f:
        json.dump([{"CoinInfo": {"Name": "BTC"}, "mktcap": 10.0}, {"CoinInfo": {}, "mktcap": 1.0}], f)
    rows = read_coin_info(spark, f"{scratch}/info.json").select("CoinInfo.Name", "mktcap").collect()
    assert sorted((r.Name or "", r.mktcap) for r in rows) == [("", 1.0), ("BTC", 10.0)]


def test_empty_batch_is_a_no_op(spark, scratch):
    from ohlcflow.sinks import batch_writer_by_symbol

    write = batch_writer_by_symbol(f"{scratch}/sink", fmt="parquet")
    empty = spark.createDataFrame([], "symbol string, close double")
    write(empty, 0)                                            # Q4: no recursion, no rows, no error
    write(spark.createDataFrame([("A", 1.0)], "symbol string, close double"), 1)
    write(spark.createDataFrame([("A", 1.0)], "symbol string, close double"), 1)   # replayed batch
    out = spark.read.parquet(f"{scratch}/sink")
    assert {r.run for r in out.collect()} == {"none"}         # called outside a stream
    assert [(r.symbol, r.close, r.batch_id) for r in out.collect()] == [("A", 1.0, 1)]
