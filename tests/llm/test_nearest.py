import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers_llm import MEDIUM, table
from ohlcflow.llm import nearest as ann
from ohlcflow.llm.queries import op13_nearest_neighbours

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.withColumns({c: F.lit("clash") for c in ("id", "k1", "vector", "rank", "query_id", "score", "near")})


def dot(v, w):
    total = 0.0  # sum() would compensate for rounding
    for a, b in zip(v, w):
        total += a * b
    return total


def brute(rows, k, every):
    """Rows of the exact answer, by row: repeated ids are rows of their own."""
    out = []
    for i, (q, v) in enumerate(rows):
        if q is None or q % every:
            continue
        found = sorted(
            (-dot(v, w), c)
            for j, (c, w) in enumerate(rows)
            if j != i and c is not None
        )
        out += [(q, r, c, -s) for r, (s, c) in enumerate(found[:k], 1)]
    return Counter(out)


def result(df, k=20, every=20):
    got = ann.nearest(df, F.col("vec_id") % every == 0, k).collect()
    return Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


@pytest.fixture()
def small_buckets(monkeypatch):
    monkeypatch.setattr(ann, "BUCKET_ROWS", 16)
    monkeypatch.setattr(ann, "GROUP_ROWS", 128)


def recall(rows, got, k, every):
    want = brute(rows, k, every)
    assert Counter((q, r) for q, r, _, _ in got.elements()) == Counter((q, r) for q, r, _, _ in want.elements())
    exact = {(q, c) for q, _, c, _ in want}
    return sum((q, c) in exact for q, _, c, _ in got) / len(exact)


def test_query_recall(spark):
    """One bucket at this size: the answer is exact, ties and scores included."""
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, "embeddings", MEDIUM).collect()]
    got = op13_nearest_neighbours(spark, MEDIUM).collect()
    assert Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute(rows, 20, 20)


def test_recall_through_buckets(spark, small_buckets):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, "embeddings", MEDIUM).collect()]
    model = ann.Polytopes(64, len(rows))
    assert model.axes == [8]
    assert recall(rows, result(table(spark, "embeddings", MEDIUM)), 20, 20) >= 0.9


def test_clusters_need_few_probes(spark, small_buckets):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 32))
    x = (centres[rng.integers(0, 12, 600)] + 0.1 * rng.normal(size=(600, 32))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert recall(rows, result(frame(spark, rows), 10, 20), 10, 20) >= 0.9


def test_several_rotations(spark, monkeypatch):
    """Buckets of four rows in 8 dimensions ask for more than one rotation."""
    monkeypatch.setattr(ann, "BUCKET_ROWS", 4)
    monkeypatch.setattr(ann, "GROUP_ROWS", 64)
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(500, 8)).astype(np.float32))]
    assert len(ann.Polytopes(8, 500).axes) == 2
    assert recall(rows, result(frame(spark, rows), 5, 20), 5, 20) >= 0.9


def test_codes_are_among_the_probes():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 12))
    model = ann.Polytopes(12, 100_000)
    assert model.size == 16 and len(model.axes) == 2
    for reach in (0.0, 0.1, 0.4):
        row, code = model.probes(x, reach)
        probed = set(zip(row.tolist(), code.tolist()))
        for t in range(model.tables):
            own = model.codes(x, t)
            assert all((i, c) in probed for i, c in enumerate(own.tolist()))
        other = rng.permutation(200)
        near = model.least_loss(x, x[other]) <= reach
        met = [any((i, int(model.codes(x[j : j + 1], t)[0])) in probed for t in range(model.tables)) for i, j in enumerate(other)]
        assert near.tolist() == met
    row, code = model.probes(x[:3], np.inf)
    assert len(row) == 3 * model.tables * model.buckets and len(set(code.tolist())) == model.tables * model.buckets


def test_copies_ties_and_repeated_ids(spark, small_buckets):
    """A third of the rows is one vector, whole numbers tie, ids repeat."""
    rng = random.Random(3)
    rows = [(i, [1.0, 0.0, 2.0, 0.0]) for i in range(100)]
    rows += [(100 + i, [float(rng.randint(-2, 2)) for _ in range(3)] + [1.0]) for i in range(200)]
    rows += [(20, [1.0, 0.0, 2.0, 0.0]), (40, [0.0, 1.0, 0.0, 1.0]), (140, rows[140][1]), (140, rows[140][1])]
    rng.shuffle(rows)
    got = result(frame(spark, rows), 20, 20)
    want = brute(rows, 20, 20)
    assert sum(got.values()) == sum(want.values())
    # Where the same places were found, scores and ties agree; most of them are.
    assert sum((got & want).values()) >= 0.9 * sum(want.values())


def test_exact_with_one_bucket(spark):
    rng = random.Random(4)
    rows = [(i % 150, [float(rng.randint(-3, 3)) for _ in range(3)] + [1.0]) for i in range(300)]
    rows += [(i, [2.0, 2.0, 2.0, 1.0]) for i in range(300, 420)]
    assert result(frame(spark, rows), 20, 10) == brute(rows, 20, 10)


def test_large_buckets_are_cut(spark, monkeypatch):
    """Near copies that no hash tells apart: their bucket is dealt over groups."""
    monkeypatch.setattr(ann, "BUCKET_ROWS", 32)
    monkeypatch.setattr(ann, "GROUP_ROWS", 40)
    rng = np.random.default_rng(8)
    near = np.array([1.0, 2.0, 3.0, 4.0]) + 1e-4 * rng.normal(size=(300, 4))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([near, rng.normal(size=(100, 4))]))]
    assert recall(rows, result(frame(spark, rows, "double"), 10, 20), 10, 20) >= 0.9


def test_vectors_that_take_no_part(spark):
    good = [(i, [float(i), 1.0]) for i in range(6)]
    bad = [None, [], [0.0, 0.0], [-0.0, 0.0], [NAN, 1.0], [1.0, INF], [1.0, None], [1.0], [1.0, 2.0, 3.0]]
    rows = good + [(20 * (i + 1), v) for i, v in enumerate(bad)] + [(None, [9.0, 9.0])]
    assert result(frame(spark, rows), 20, 2) == brute(good, 20, 2)
    assert not result(frame(spark, [(i, v) for i, v in enumerate(bad)]))
    assert not result(frame(spark, []))
    assert not result(frame(spark, [(0, [1.0, 2.0])]))  # no other row
    assert not result(frame(spark, [(1, [1.0, 2.0]), (3, [1.0, 2.0])]))  # no query
    huge = [(i, [1e200 * (i + 1), -1e150]) for i in range(4)]
    assert sum(result(frame(spark, huge, "double"), 2, 2).values()) == 4
