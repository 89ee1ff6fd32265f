import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers_llm import SMALL, table
from ohlcflow.llm import whitening
from ohlcflow.llm.queries import op11_embedding_whitening

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    return df.withColumns({c: F.lit("clash") for c in ("n", "component", "i", "lo", "whitened", "label")})


def check(vectors, got, components=8):
    """Rows of the result against integers and a plain eigh."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(col) for col in zip(*x)]
    v = np.array([[(n * sum(r[i] * r[j] for r in x) - s[i] * s[j]) / (n * n) for j in range(d)] for i in range(d)])
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(components, d)
    assert len(got) == n * k
    dev = sorted(sum((n * a - b) ** 2 for a, b in zip(r, s)) for r in x)
    centred = np.array(x, float) - np.array(s, float) / n
    for c in range(1, k + 1):
        rows = [r for r in got if r["component"] == c]
        assert len(rows) == n and {r["n"] for r in rows} == {n}
        assert sorted(int(r["deviation"]) for r in rows) == dev
        if values[c - 1] <= 1e-10 * values[0]:
            assert all(r["whitened"] is None and r["explained"] == 0 for r in rows)
            continue
        assert all(abs(r["explained"] * np.trace(v) / values[c - 1] - 1) < 1e-6 for r in rows)
        assert all(r["identity_error"] < 1e-4 for r in rows)
        # The projection is on a unit eigenvector: V u = e u.
        w = np.array([r["whitened"] for r in sorted(rows, key=lambda r: r["vec_id"])]) * math.sqrt(values[c - 1])
        u = centred.T @ w / n / values[c - 1]
        assert abs(np.linalg.norm(u) - 1) < 1e-9 and np.allclose(v @ u, values[c - 1] * u, atol=1e-8 * values[0])
        assert np.allclose(centred @ u, w, atol=1e-7 * max(1.0, np.abs(w).max()))


def test_scatter_is_exact():
    rng = np.random.default_rng(1)
    for span in (1, 2, 1000, 2**31, 2**62):
        for rows in (1, 63, 64, 65, 1000):
            x = rng.integers(-span, span, (rows, 5))
            s, c = whitening.scatter(x)
            whole = x.astype(object)
            assert (s == whole.sum(axis=0)).all() and (c == whole.T.dot(whole)).all()


def test_limbs_add_up():
    for v in (0, 1, -1, 2**126, -(2**130) + 12345, 10**20):
        assert sum(p << (whitening.LIMB * k) for k, p in enumerate(whitening._limbs(v))) == v


def test_query_against_integers(spark):
    rows = table(spark, "embeddings").orderBy("vec_id").collect()
    got = op11_embedding_whitening(spark, SMALL).collect()
    check([r["embedding"] for r in rows], got)
    assert {r["vec_id"] for r in got} == {r["vec_id"] for r in rows}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_unusable_rows_and_few_dimensions(spark, kind):
    good = [[0.5, -1.25, 3.0], [0.25, 7.5, -99.0], [0.0, 0.0, 0.0], [0.5, -1.25, 3.0], [100.0, 2.0, 1.0]]
    bad = [None, [], [NAN, 1.0, 2.0], [1.0, INF, 2.0], [1.0, None, 2.0], [1.0], [1.0, 2.0, 3.0, 4.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(100 + i, v) for i, v in enumerate(bad)]
    got = whitening.whiten(frame(spark, rows, kind)).collect()
    assert {r["vec_id"] for r in got} == set(range(len(good)))
    check(good, got)


def test_no_variance(spark):
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["component"], r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in one] == [
        (1, None, 0.0, 0, 0.0),
        (2, None, 0.0, 0, 0.0),
    ]
    flat = [[float(i), 5.0] for i in range(7)]
    check(flat, whitening.whiten(frame(spark, list(enumerate(flat)))).collect())


def test_repeated_rows_and_null_ids_count(spark):
    vectors = [[1.0, 2.0], [1.0, 2.0], [3.0, -1.0], [0.5, 0.5]]
    rows = list(zip([7, 7, None, 8], vectors))
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 8 and {r["n"] for r in got} == {4}
    assert sum(r["vec_id"] is None for r in got) == 2


def test_wide_values_stay_exact(spark):
    """Cross products beyond a long, and values beyond a long's range."""
    vectors = [[2.0**40, 1.0], [-(2.0**41), 3.0], [2.0**39, -7.0], [5.0, 0.0]]
    got = whitening.whiten(frame(spark, list(enumerate(vectors)), "double")).collect()
    check(vectors, got)
    far = whitening.whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0])], "double")).collect()
    assert len(far) == 4 and all(r["n"] == 2 for r in far)


def test_empty_and_clashing(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    for name in ("n", "component"):
        with pytest.raises(ValueError):
            whitening.whiten(frame(spark, [(1, [1.0])]), ids=("vec_id", name))
