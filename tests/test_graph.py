import threading

import pytest

from ohlcflow import fixtures
from ohlcflow.apps import batch_graph
from ohlcflow.jobs import Stage, StageFailure, run_graph, stage_order
from ohlcflow.sinks import land_payloads

from conftest import SF_SMALL


def test_order_and_mistakes():
    a, b, c = Stage("a", print, ("b", "c")), Stage("b", print, ("c",)), Stage("c", print)
    assert stage_order([a, b, c]) == ["c", "b", "a"]
    for bad in ([a, a], [Stage("x", print, ("y",))], [Stage("x", print, ("y",)), Stage("y", print, ("x",))]):
        with pytest.raises(ValueError):
            stage_order(bad)


def test_a_failing_middle_stage(spark, scratch):
    """Three collectors side by side, one of them fails: the others end, what waits for it
    does not begin; the rerun does what is open and nothing again."""
    ran, together, broken = [], threading.Barrier(3, timeout=60), [True]

    def collector(name):
        def run(s):
            if broken[0]:
                together.wait()  # only passed if all three run at once
            assert s.sparkContext.getLocalProperty("spark.scheduler.pool") == name
            assert s.sparkContext.getLocalProperty("from.caller") == "yes"
            if name == "hourly" and broken[0]:
                raise OSError("rate limit")
            ran.append((name, s.range(10).count()))

        return run

    stages = [Stage(n, collector(n)) for n in ("daily", "hourly", "minutely")]
    stages += [
        Stage("bars", lambda s: ran.append(("bars", 0)), ("daily", "hourly", "minutely")),
        Stage("serve", lambda s: ran.append(("serve", 0)), ("bars",)),
        Stage("report", lambda s: ran.append(("report", 0)), ("daily",)),
    ]
    spark.sparkContext.setLocalProperty("from.caller", "yes")
    with pytest.raises(StageFailure) as told:
        run_graph(spark, stages, scratch)
    assert list(told.value.failed) == ["hourly"] and told.value.skipped == ["bars", "serve"]
    assert sorted(n for n, _ in ran) == ["daily", "minutely", "report"]
    broken[0] = False
    ran.clear()
    outcome = run_graph(spark, stages, scratch)
    assert [n for n, _ in ran] == ["hourly", "bars", "serve"]
    assert {n for n, o in outcome.items() if o == "kept"} == {"daily", "minutely", "report"}
    ran.clear()
    assert set(run_graph(spark, stages, scratch).values()) == {"kept"} and not ran
    spark.sparkContext.setLocalProperty("from.caller", None)


def test_one_at_a_time(spark, scratch):
    busy, most = [], []

    def run(s):
        busy.append(1)
        most.append(len(busy))
        busy.pop()

    run_graph(spark, [Stage(str(n), run) for n in range(5)], scratch, max_parallel=1)
    assert most == [1] * 5


def test_the_batch_as_a_graph(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    payloads = fixtures.bar_payloads(ev, 100)

    def collect(rest):
        return lambda s: land_payloads(payloads.where(f"chunk_no % 3 = {rest}"), f"{scratch}/raw")

    sources = {tier: collect(n) for n, tier in enumerate(("daily", "hourly", "minutely"))}
    graph = batch_graph(sources, f"{scratch}/raw", f"{scratch}/bars", f"{scratch}/docs")
    outcome = run_graph(spark, graph, f"{scratch}/state")
    assert len(outcome) == 5 and set(outcome.values()) == {"done"}
    assert spark.read.json(f"{scratch}/docs").count() == ev.where("event_type <> 'error'").count()
