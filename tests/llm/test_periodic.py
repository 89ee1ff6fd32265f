import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from helpers_llm import SMALL, make, table  # noqa: F401
from ohlcflow.llm import periodic
from ohlcflow.llm.queries import op12_periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    """All runs ``(start, length, period)`` by scanning every lag."""
    names = {}
    w = np.array([names.setdefault(x, len(names)) for x in words], np.int64)
    out = []
    for q in range(1, len(w) // 2 + 1):
        t = np.flatnonzero(w[q:] == w[:-q])
        if not len(t):
            continue
        cut = np.flatnonzero(np.diff(t) != 1)
        for s, e in zip(t[np.append(0, cut + 1)].tolist(), (t[np.append(cut, len(t) - 1)] + q + 1).tolist()):
            if e - s < max(least, 2 * q):
                continue
            if not any(q % d == 0 and (w[s : e - d] == w[s + d : e]).all() for d in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(words) if i not in dropped)


def a_text(rng):
    kind, k = rng.randrange(7), rng.choice([1, 2, 3, 5, 50, 1000])
    base = [rng.randrange(k) for _ in range(rng.randint(0, 700))]
    if kind == 1:
        u = [rng.randrange(k) for _ in range(rng.randint(1, 150))]
        return (u * 600)[: rng.randint(0, 600)] + base[:50]
    if kind == 2:
        x = [rng.randrange(2) for _ in range(rng.randint(1, 4))] * rng.randint(1, 60)
        return (x + [rng.randrange(3)] * rng.randint(0, 2)) * rng.randint(1, 4) + base[: rng.randint(0, 40)]
    if kind == 3:  # Fibonacci words: runs of every scale within one another
        a, b = [1], [1, 0]
        while len(b) < 500:
            a, b = b, b + a
        return b
    if kind == 4:  # Thue-Morse words: no cubes
        x = [0]
        while len(x) < 300:
            x = x + [1 - v for v in x]
        return x
    if kind == 5:  # two runs of one short period that touch
        u = [rng.randrange(2) for _ in range(rng.randint(1, 3))]
        v = u * rng.randint(20, 80)
        w = v + [9] * rng.randint(0, 1) + u[: rng.randint(0, 3)] + v[rng.randint(0, 5) :]
        return w + w[rng.randint(0, len(w) // 2) :]
    if kind == 6:
        x = base[: rng.randint(1, 120)]
        while x and len(x) < 500:
            x = x * rng.randint(2, 3)
            x[rng.randrange(len(x))] = 7
        return x[:900]
    return base


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_texts(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [a_text(rng) for _ in range(rng.randint(1, 5))]
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        got = periodic.find_runs(np.array([x for t in texts for x in t], np.int64), first)
        assert [tuple(r) for r in got.tolist()] == [(i, *r) for i, t in enumerate(texts) for r in brute(t)]


def test_long_texts_are_linear():
    """Texts whose pairs of equal blocks grow with the square: one word over and over, and
    two runs of one period side by side, which have thousands of runs across the seam."""
    for w, n in (([7] * 400_000, 1), ([0, 1] * 20_000 + [0] + [0, 1] * 20_000, 19_999)):
        runs = periodic.find_runs(np.array(w, np.int64), np.array([0, len(w)]))
        assert len(runs) >= n
        for _, s, length, q in runs[:: max(1, len(runs) // 50)].tolist():
            assert w[s : s + length - q] == w[s + q : s + length] and length >= 2 * q


def test_operator(spark, make):  # noqa: F811
    u = [f"w{i}" for i in range(90)]
    texts = {
        1: None, 2: "", 3: " \t\n", 4: "no run here", 5: "a " * 12, 6: "a " * 11, 7: "\x0b".join(u * 3),
        8: "é" + " é" * 30, 9: " ".join(u * 3), 10: ("x y z " * 5000) + "end",
    }
    rows = list(texts.items()) + [(5, texts[5]), (None, texts[7])]
    docs = make([(k, t) for k, t in rows])
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    want = sorted((str(k), WORD.findall(t or "")) for k, t in rows)
    assert sorted(str(r["doc_id"]) for r in got) == [k for k, _ in want]
    for r in got:
        words = WORD.findall(texts[r["doc_id"] or 7] or "")
        runs = [tuple(x) for x in r["runs"]]
        assert runs == brute(words) and r["n_words"] == len(words)
        assert r["collapsed"] == collapsed(words, runs)
    by = {r["doc_id"]: r for r in got}
    assert [tuple(x) for x in by[9]["runs"]] == [(0, 270, 90)] and by[5]["collapsed"] == "a" and not by[6]["runs"]
    assert periodic.periodic_runs(make([(1, "x")]).where("doc_id > 1")).collect() == []
    for name in ("runs", "n_words", "collapsed"):
        with pytest.raises(ValueError):
            periodic.periodic_runs(docs, ids=(name,))


def test_query_against_brute_force(spark):
    got = {r["doc_id"]: r for r in op12_periodic_runs(spark, SMALL).collect()}
    docs = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    assert got.keys() == docs.keys()
    planted = 0
    for k, text in docs.items():
        w = WORD.findall(text or "")
        h, n = zlib.crc32(str(k).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
            planted += 1
        runs, r = brute(w), got[k]
        assert r["n_runs"] == len(runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert planted > 10
