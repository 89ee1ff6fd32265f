import random

from pyspark.sql import functions as F

from ohlcflow.operators.ranking import chunk_symbols, rank_symbols, row_index, top_n
from ohlcflow.operators.setops import except_all


def test_row_index_matches_sorted_order(spark):
    rnd = random.Random(7)
    rows = [(i, round(rnd.random() * 100, 1)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(5)
    got = row_index(df, [F.col("v").desc(), F.col("k")], num_partitions=6).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [(r.k, r.row_idx) for r in sorted(got, key=lambda r: r.row_idx)] == [
        (k, i + 1) for i, (k, _) in enumerate(want)
    ]
    plan = row_index(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan          # no single-partition window


def test_rank_and_chunks(spark):
    df = spark.createDataFrame([(f"S{i}", float(i % 7), i) for i in range(25)], "symbol string, total double, key int")
    ranked = rank_symbols(df, value="total", key="key")
    by_rank = {r["rank"]: r.key for r in ranked.collect()}
    assert by_rank[1] == 6 and by_rank[2] == 13 and by_rank[25] == 21
    chunks = {r.chunk_no: r for r in chunk_symbols(ranked, 10).collect()}
    assert [chunks[c].n_symbols for c in sorted(chunks)] == [10, 10, 5]
    assert chunks[0].symbols.split(",")[:2] == ["S6", "S13"]


def test_top_n_is_take_ordered(spark):
    df = spark.createDataFrame([(i, float(i % 5)) for i in range(100)], "k int, v double")
    top = top_n(df, 3, [F.col("v").desc(), "k"])
    assert [r.k for r in top.collect()] == [4, 9, 14]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_except_all_is_multiset(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (4, "d")], "x int, y string")
    b = spark.createDataFrame([(1, "a"), (3, "c"), (2, None), (4, "d"), (4, "d")], "x int, y string")
    got = sorted(tuple(r) for r in except_all(a, b).collect())
    assert got == sorted(tuple(r) for r in a.exceptAll(b).collect()) == [(1, "a"), (1, "a"), (2, None)]


def test_except_all_spreads_a_hot_row(spark):
    hot = spark.range(25000).select(F.lit(7).alias("k"))
    rest = spark.range(100).select((F.col("id") + 100).alias("k"))
    left = hot.unionByName(rest)
    right = spark.createDataFrame([(7,), (7,), (100,)], "k long")
    out = except_all(left, right, block=1000)
    assert out.count() == 25000 - 2 + 99
    sizes = out.where("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 25000
