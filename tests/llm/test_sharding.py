import random
import zlib

import pytest

from brute import smallest_capacity
from helpers_llm import MEDIUM, make, table  # noqa: F401
from ohlcflow.llm import sharding


def check(rows, out, n):
    size = lambda t: len((t or "").encode()) + 1
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted(rows, key=str)
    groups, where, slots, total = {}, {}, {}, {}
    for r in out:
        assert r["shard_size"] == size(r["text"])
        groups[r["shard_key"]] = groups.get(r["shard_key"], 0) + r["shard_size"]
        assert where.setdefault(r["shard_key"], r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        total[r["shard"]] = total.get(r["shard"], 0) + r["shard_size"]
    # Equal texts share a key, different ones do not.
    assert len(groups) == len({t for _, t in rows})
    order = sorted(groups)
    assert [where[k] for k in order] == sorted(where[k] for k in order)  # contiguous
    assert all(0 <= s < n for s in total)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())  # gapless
    assert max(total.values(), default=0) == smallest_capacity([groups[k] for k in order], n)


def test_documents(spark):
    docs = table(spark, "documents", MEDIUM).select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    check(rows, sharding.shard_documents(docs).collect(), 8)


@pytest.mark.parametrize("seed", range(4))
def test_random_sizes(spark, make, seed):
    rng = random.Random(seed)
    texts = [f"{i}" + "x" * int(rng.paretovariate(0.7) * 10 % 5000) for i in range(rng.randint(1, 300))]
    rows = [(i, rng.choice(texts)) for i in range(rng.randint(1, 600))]
    n = rng.choice([1, 2, 8])
    check(rows, sharding.shard_documents(make(rows), n).collect(), n)


def test_cells_are_split_as_far_as_needed(monkeypatch, spark, make):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 1)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    rows = [(i, f"text {i} " * (i % 11)) for i in range(400)]
    check(rows, sharding.shard_documents(make(rows), 5).collect(), 5)


def test_edge_cases(spark, make):
    rows = [(1, None), (2, None), (3, ""), (3, ""), (None, "a"), (None, "a"), (4, "é" * 50_000), (5, "b")]
    check(rows, sharding.shard_documents(make(rows)).collect(), 8)


def test_one_text_holds_a_third(spark, make):
    rows = [(i, "hot text " * 3) for i in range(300)] + [(1000 + i, f"t{i} " * 6) for i in range(600)]
    check(rows, sharding.shard_documents(make(rows)).collect(), 8)


def test_empty_table(spark, make):
    out = sharding.shard_documents(make([]))
    assert out.collect() == []
    assert {"shard_size", "shard_key", "shard", "slot"} <= set(out.columns)


def test_query_columns(spark):
    from ohlcflow.llm.queries import op3_minimax_sharding

    rows = op3_minimax_sharding(spark, "/root/testdata/sf0.001").collect()
    text = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    assert len(rows) == len(text)
    for r in rows:
        assert r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
