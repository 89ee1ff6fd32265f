import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ohlcflow.operators.asof import as_of, last_n_as_of, numbered

T0 = datetime(2024, 1, 1)
TICK = "symbol string, ts timestamp, id long, price double"
ASK = "rid int, symbol string, at timestamp"


def data(seed, n=120, span=5000):
    rng = random.Random(seed)
    at = lambda: T0 + timedelta(seconds=rng.randrange(-span, span))
    ticks = [(rng.choice("ABC"), at(), i, rng.choice([1.0, 2.0, None, 3.5])) for i in range(n)]
    ticks += [("H", T0 + timedelta(seconds=10 * i), 1000 + i, float(i)) for i in range(n)]  # a hot symbol
    ticks += [(None, T0, 1, 1.0), ("A", None, 2, 1.0)]
    asks = [(i, rng.choice("ABCHZ"), at()) for i in range(n)]
    asks += [asks[0], (-1, None, T0), (-2, "A", None), (-3, ticks[0][0], ticks[0][1])]
    return ticks, asks


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("bucket", [1, 300, 10**6])
def test_as_of(spark, seed, bucket):
    ticks, asks = data(seed)
    got = as_of(spark.createDataFrame(asks, ASK), spark.createDataFrame(ticks, TICK), ["symbol"], ["price", "id"], tiebreak="id", bucket_seconds=bucket)
    assert got.columns == ["rid", "symbol", "at", "price", "id", "as_of"]
    want = []
    for rid, symbol, at in asks:
        before = [t for t in ticks if symbol and at and t[0] == symbol and t[1] is not None and t[1] <= at]
        best = max(before, key=lambda t: (t[1], t[2]), default=(None, None, None, None))
        want.append((rid, symbol, at, best[3], best[2], best[1]))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_as_of_plan_is_dealt_by_bucket(spark):
    ticks, asks = data(1)
    df = as_of(spark.createDataFrame(asks, ASK), spark.createDataFrame(ticks, TICK), ["symbol"], ["price"], tiebreak="id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "NestedLoop" not in plan
    assert "windowspecdefinition(symbol" in plan and "_b" in plan
    with pytest.raises(ValueError):
        as_of(spark.createDataFrame(asks, ASK).withColumn("price", F.lit(1)), spark.createDataFrame(ticks, TICK), ["symbol"], ["price"])
    none = spark.createDataFrame([], TICK)
    assert {r.price for r in as_of(spark.createDataFrame(asks, ASK), none, ["symbol"], ["price"]).collect()} == {None}
    assert as_of(spark.createDataFrame([], ASK), spark.createDataFrame(ticks, TICK), ["symbol"], ["price"]).collect() == []


@pytest.mark.parametrize("bucket", [60, 86400])
@pytest.mark.parametrize("limit", [1, 3, 50])
def test_last_n_as_of(spark, bucket, limit):
    ticks, asks = data(limit)
    bars = {(t[0], t[1]): t for t in ticks}.values()  # one per time
    asks = asks[:-4]
    df = spark.createDataFrame(list(bars), TICK)
    got = last_n_as_of(spark.createDataFrame(asks, ASK), df, limit, ["symbol"], ["rid", "symbol"], at="at", bucket_seconds=bucket)
    want = []
    for rid, symbol, at in asks:
        before = sorted(t[1:] for t in bars if t[0] == symbol and t[1] is not None and t[1] <= at)
        want += [(rid, symbol, *t) for t in before[-limit:]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_numbered(spark):
    ticks = sorted({(t[0], t[1]) for t in data(2)[0] if t[0] and t[1]})
    df = spark.createDataFrame(ticks, "symbol string, ts timestamp")
    got = {(r.symbol, r.ts): r.position for r in numbered(df, ["symbol"], "ts", 200).collect()}
    seen = {}
    for symbol, ts in ticks:
        assert got[symbol, ts] == seen.get(symbol, 0)
        seen[symbol] = seen.get(symbol, 0) + 1
