import hashlib
import random
import re

import pytest

from helpers_llm import MEDIUM, make, table  # noqa: F401
from ohlcflow.llm import exact_dedup as ed


def want(rows):
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in rows]
    groups = {}
    for d, t in norm:
        groups.setdefault(t, []).append(d)
    out = []
    for d, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((d, keep, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(
        ((r["doc_id"], r["keep_id"], r["group_size"], bytes(r["content"]).hex()) for r in df.collect()), key=str
    )


def test_matches_brute_force_on_documents(spark):
    docs = table(spark, "documents", MEDIUM).select("doc_id", "text")
    assert rows_of(ed.exact_duplicates(docs)) == want([tuple(r) for r in docs.collect()])


def test_edge_cases(spark, make):
    rows = [
        (4, "a  b"), (2, "a\tb"), (9, "a b "), (1, None), (3, ""), (2, "a b"), (2, "other"), (None, "a b"),
        (None, "alone"), (1 << 62, "long " * 50_000), ((1 << 62) + 1, "long " * 50_000), (7, "É"), (8, "é"),
    ]
    out = ed.exact_duplicates(make(rows))
    assert rows_of(out) == want(rows)
    kept = sorted(str((r["doc_id"], r["group_size"])) for r in out.collect() if r["kept"])
    # One row of each content, of rows equal in id and content as well.
    assert len(kept) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows})


def test_empty_table(spark, make):
    assert ed.exact_duplicates(make([])).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_filter_has_no_false_negatives_and_forgets(seed):
    rng = random.Random(seed)
    index, live = ed.BucketIndex(8), {}
    for _ in range(6000):
        d = rng.randrange(1500)
        digest = (d * 0x9E3779B97F4A7C15 & ((1 << 64) - 1)) - (1 << 63)
        # Two contents share each digest.
        content = bytes([d % 2]) + (d // 2).to_bytes(4, "big")
        digest = digest if d % 2 else digest ^ 0
        if rng.random() < 0.6:
            index.insert(digest, content, d, 1)
            live[digest, content] = live.get((digest, content), 0) + 1
        elif live.get((digest, content)):
            assert index.delete(digest, content, d, 1) == 1
            live[digest, content] -= 1
        else:
            assert index.delete(digest, content, d, 1) == 0
    live = {k: n for k, n in live.items() if n}
    assert {(r["digest"], r["content"]): r["n"] for r in index.rows()} == live
    assert all(digest in index.filter for digest, _ in live)
    assert index.resizes > 0  # overflow, rebuilt from the stored keys


def test_filter_keeps_false_positives_rare():
    f = ed.CuckooFilter(1 << 14)
    for i in range(12_000):
        assert f.insert(i * 0x9E3779B97F4A7C15)
    wrong = sum((i * 0xD1342543DE82EF95 + 7) in f for i in range(100_000, 120_000))
    assert wrong < 20


def test_colliding_digests_are_told_apart_by_content():
    index = ed.BucketIndex()
    index.insert(5, b"x", 10, 1)
    index.insert(5, b"y", 11, 1)
    index.insert(5, b"x", 3, 2)
    assert sorted((r["content"], r["keeper"], r["n"]) for r in index.rows()) == [(b"x", 3, 3), (b"y", 11, 1)]
    index.delete(5, b"x", 3, 3)
    assert 5 in index.filter and [r["content"] for r in index.rows()] == [b"y"]


def test_index_lives_on(spark, make):
    index = ed.DedupIndex.empty(spark, 10)
    index = index.insert(make([(1, "a"), (2, "a"), (3, "b")]))
    index = index.insert(make([(0, "a"), (5, "c")]))
    state = lambda i: sorted((k["keeper"], k["n"]) for k in i.keys().collect())
    assert state(index) == [(0, 3), (3, 1), (5, 1)]
    index = index.delete(make([(3, "b"), (5, "c"), (6, "never there")]))
    assert state(index) == [(0, 3)]
    # The keeper goes: a new one is elected among the live rows.
    index = index.delete(make([(0, "a")]))
    assert [(k["keeper"], k["n"]) for k in index.keys().collect()] == [(None, 2)]
    index = index.elect(make([(1, "a"), (2, "a")]))
    assert state(index) == [(1, 2)]
    found = index.lookup(ed.digests(make([(7, "a"), (8, "b")]))).collect()
    assert sorted((r["doc_id"], r["keeper"]) for r in found) == [(7, 1), (8, None)]


def test_any_long_is_an_id(spark, make):
    """The greatest and least longs, 0 and null: one row of each group stays."""
    top, low = 2**63 - 1, -(2**63)
    rows = [(top, "a"), (top, "a"), (None, "b"), (top, "b"), (low, "c"), (top, "c"), (0, "d"), (None, "d"), (None, "e"), (None, "e")]
    got = ed.exact_duplicates(make(rows)).collect()
    keep = {"a": top, "b": top, "c": low, "d": 0, "e": None}
    by = {}
    text = dict(zip([r["content"] for r in ed.digests(make([(1, t) for t in keep])).collect()], keep))
    for r in got:
        by.setdefault(text[r["content"]], []).append((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]))
    for t, found in by.items():
        assert len(found) == 2 and {x[1] for x in found} == {keep[t]} and sum(x[3] for x in found) == 1, (t, found)
        assert all(x[0] == keep[t] for x in found if x[3])
