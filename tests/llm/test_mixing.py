import hashlib
import re

import pytest
from pyspark.sql import functions as F

from helpers_llm import MEDIUM, make, table  # noqa: F401
from ohlcflow.llm import mixing


def targets(sizes, weights, share, cap):
    """The excess of full sources shared again by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        left = budget - sum(cap * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        level = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if w[s] * level >= cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in full else w[s] * level for s in order}
        full |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, out, weights=(3, 1, 2), share=1.5, cap=2.0):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    want = targets(sizes, weights, share, cap)
    taken, biggest = {}, {}
    assert len(out) == len(rows)
    for r in out:
        s = r["source"]
        assert r["mix_source_size"] == sizes[s]
        assert r["mix_target"] == pytest.approx(want[s])
        assert 0 <= r["mix_copies"] <= cap
        assert r["mix_size"] > 0 or r["mix_copies"] == 0
        taken[s] = taken.get(s, 0) + r["mix_copies"] * r["mix_size"]
        biggest[s] = max(biggest.get(s, 0), r["mix_size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= biggest[s], s
    return taken, want


def test_documents(spark):
    docs = table(spark, "documents", MEDIUM).select("doc_id", "text", "source")
    rows = [tuple(r) for r in docs.collect()]
    out = mixing.pareto_mix(docs).collect()
    taken, want = check(rows, out)
    off = [abs(taken[s] - want[s]) / max(want[s], 1) for s in want]
    assert sorted(off)[len(off) // 2] < 0.01
    again = mixing.pareto_mix(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["mix_copies"]) for r in out) == sorted((r["doc_id"], r["mix_copies"]) for r in again)


def test_edge_cases(spark, make):
    rows = [(i, "w " * (i % 7), s) for i, s in enumerate(["a", "b", None, "B", "é"] * 12)]
    rows += [(None, "x y z", "a"), (None, "x y z", "a"), (3, None, "b"), (4, "", None), (1, "q " * 9, "empty")]
    rows += [(900, " \t", "blank"), (901, "k " * 40_000, "long")]
    check(rows, mixing.pareto_mix(make(rows)).collect())


def test_one_source_of_copies_holds_most_rows(spark, make):
    rows = [(5000, "same text here", "hot")] * 200 + [(i, f"t{i} u v w", "hot") for i in range(100)]
    rows += [(1000 + i, "a b c d e", f"s{i % 3}") for i in range(30)]
    out = mixing.pareto_mix(make(rows)).collect()
    # Rows equal in id and text are taken alike.
    assert len({r["mix_copies"] for r in out if r["doc_id"] == 5000}) == 1


def test_empty_table(spark, make):
    assert mixing.pareto_mix(make([])).collect() == []
    assert mixing.mixed_documents(make([])).collect() == []
    out = mixing.pareto_mix(make([(1, None, "a"), (2, "", "b")])).collect()
    assert [r["mix_copies"] for r in out] == [0, 0]


def test_copies_become_rows(spark, make):
    rows = [(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(40)]
    df = make(rows)
    plan = {r["doc_id"]: r["mix_copies"] for r in mixing.pareto_mix(df).collect()}
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    got = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {d: n for d, n in plan.items() if n}


def test_unequal_inclusion(spark, make):
    """Documents of more importance are taken more often; certain copies come whole."""
    rows = [(i, "a b c d", "s") for i in range(1200)]
    df = make(rows).withColumn("quality", F.when(F.col("doc_id") < 400, 4.0).otherwise(1.0))
    out = mixing.pareto_mix(df, weights=(1,), share=0.5, importance="quality").collect()
    good = sum(r["mix_copies"] for r in out if r["doc_id"] < 400) / 400
    rest = sum(r["mix_copies"] for r in out if r["doc_id"] >= 400) / 800
    assert good == pytest.approx(1.0) and rest == pytest.approx(0.25, abs=0.01)
    assert all(r["mix_copies"] >= 1 for r in out if r["doc_id"] < 400)


def test_inclusion_probabilities(spark, make):
    """Over many seeds each document is taken as often as its inclusion says."""
    n, seeds = 30, 40
    rows = [(i, "a b", "s") for i in range(n)]
    df = make(rows).withColumn("quality", F.lit(1.0) + F.col("doc_id") % 3)
    hits = dict.fromkeys(range(n), 0)
    for seed in range(seeds):
        u = df.select("doc_id", "quality", mixing.uniform(F.col("doc_id"), str(seed)).alias("u")).collect()
        total = sum(r["quality"] for r in u)
        p = {r["doc_id"]: 12 * r["quality"] / total for r in u}
        rank = sorted(u, key=lambda r: (r["u"] / (1 - r["u"])) / (p[r["doc_id"]] / (1 - p[r["doc_id"]])))
        for r in rank[:12]:
            hits[r["doc_id"]] += 1
    by = [sum(hits[d] for d in range(n) if d % 3 == k) / (seeds * n / 3) for k in range(3)]
    assert by == pytest.approx([0.2, 0.4, 0.6], abs=0.08)


def test_uniform_is_the_md5(spark):
    digest = hashlib.md5(b"mix:42").hexdigest()[:12]
    got = spark.range(42, 43).select(mixing.uniform(F.col("id"), "mix").alias("u")).first()["u"]
    assert got == (int(digest, 16) + 0.5) / 2**48


def test_small_tables_are_counted_once_and_garbage_is_let_go(spark, make, monkeypatch):
    """A driver of 1500 MB ran out of memory on many small plans: no table of a line per source is
    counted again, and what earlier steps left is let go between them."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    from ohlcflow.llm import common

    calls, count, release = [], Frame.count, common.Scratch.release
    monkeypatch.setattr(Frame, "count", lambda self: calls.append("count") or count(self))
    monkeypatch.setattr(common.Scratch, "release", lambda self: calls.append("release") or release(self))
    rows = [(i, "word " * (i % 7 + 1), "abc"[i % 3]) for i in range(60)]
    out = mixing.pareto_mix(make(rows)).collect()
    monkeypatch.undo()
    check(rows, out)
    assert calls.count("count") == 1 and calls.count("release") >= 5
    written = common.scratch_path(spark, "count")
    spark.range(3).write.parquet(written)
    frame = spark.read.parquet(written)
    monkeypatch.setattr(Frame, "count", lambda self: calls.append("again") or count(self))
    for _ in range(2):
        common.broadcast_if_small(frame)
    assert calls.count("again") == 1
