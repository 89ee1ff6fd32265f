import os
import random

import numpy as np
import pytest

from brute import jaccard_components, shingles
from helpers_llm import MEDIUM, make, table  # noqa: F401
from ohlcflow.llm import ngram_join as nj
from ohlcflow.llm.common import Scratch


def components(df, **kw):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in nj.ngram_components(df, **kw).collect()}


@pytest.mark.parametrize("n, percent, n2", [(3, 90, 3), (5, 80, 2)])
def test_matches_brute_force_on_documents(spark, n, percent, n2):
    docs = table(spark, "documents", MEDIUM)
    sets = {r["doc_id"]: shingles(r["text"], n) for r in docs.collect()}
    want = jaccard_components(sets, percent)
    got = components(docs, shingle=n, percent=percent, n2=n2)
    assert got == {k: (len(sets[k]), want[k]) for k in sets}


@pytest.mark.parametrize("percent, n2", [(90, 3), (80, 2), (80, 3), (60, 2)])
def test_linked_sets_share_a_signature(percent, n2):
    """The guarantee itself: random pairs at and above the threshold, all sizes."""
    rng = np.random.default_rng(percent)
    for _ in range(300):
        a = int(rng.integers(1, 400))
        # |A & B| / |A | B| >= percent: take some out, put some in.
        x = rng.integers(0, 2**63, a).astype(np.uint64)
        x = np.unique(x)
        gone = int(rng.integers(0, a * (100 - percent) // 100 + 1))
        room = (len(x) - gone) * 100 // percent - len(x)
        new = rng.integers(0, 2**63, int(rng.integers(0, max(room, 0) + 1))).astype(np.uint64)
        y = np.unique(np.concatenate([x[gone:], new]))
        both = len(np.intersect1d(x, y))
        if 100 * both < percent * (len(x) + len(y) - both) or np.array_equal(x, y):
            continue
        idx, sig = nj.signatures([x, y], percent, n2)
        assert set(sig[idx == 0].tolist()) & set(sig[idx == 1].tolist()), (len(x), len(y), both)


def test_edge_cases(spark, make):
    near = " ".join(f"w{i}" for i in range(40))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, near), (8, near.upper()),
        (9, near + " more"), (9, near + " more"), (None, near), (11, "É é x"), (12, "é é x"),
        (13, "far " * 30_000), (14, "a\x0bb c"), (15, "a b\x0cc"),
    ]
    got = {}
    for r in nj.ngram_components(make(rows), shingle=3, percent=90, n2=3).collect():
        got.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert got[1] == [(0, 1)] and got[2] == [(0, 2)] and got[3] == [(0, 3)]
    assert got[4] == [(1, 4)] and got[5] == [(1, 4)] and got[6] == [(1, 6)]
    assert got[7] == [(38, 7)] and got[8] == [(38, 7)] and got[9] == [(39, 7)] * 2
    assert got[None] == [(38, None)]
    assert got[11] == [(1, 11)] and got[12] == [(1, 12)]  # only A-Z are folded
    assert got[13] == [(1, 13)]
    assert got[14] == [(1, 14)] and got[15] == [(1, 14)]


def test_empty_table(spark, make):
    assert nj.ngram_components(make([])).collect() == []
    assert nj.keep_one_per_component(make([])).collect() == []


def test_group_of_near_copies_that_do_not_all_link(spark, make):
    """Many variants around one text: links by chance of the edits, held against brute force."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for d in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(1000)}"
        rows.append((d, " ".join(w)))
    sets = {d: shingles(t, 3) for d, t in rows}
    want = jaccard_components(sets, 80)
    got = components(make(rows), shingle=3, percent=80, n2=2)
    assert {k: v[1] for k, v in got.items()} == want


def family(rng, members, words_, replaced):
    """Texts that differ from one base, each in its own places: alike, but not linked."""
    base = [f"b{i}" for i in range(words_)]
    out = []
    for d in range(members):
        w = list(base)
        for i in rng.sample(range(words_), replaced):
            w[i] = f"x{d}_{i}"
        out.append((d, " ".join(w)))
    return out


@pytest.mark.parametrize("mates", [4096, 5])
def test_mates_of_large_and_small_leaders(spark, make, monkeypatch, mates):
    """Sketches compared in a task, and differences beyond the bound, find the same links."""
    monkeypatch.setattr(nj, "MATES", mates)
    rng = random.Random(9)
    rows = family(rng, 60, 80, 3)
    # Some members are copied with a word changed: linked with their origin, not with the rest.
    rows += [(100 + d, rows[d][1] + " tail") for d in range(0, 60, 4)]
    sets = {d: shingles(t, 3) for d, t in rows}
    want = jaccard_components(sets, 90)
    got = components(make(rows), shingle=3, percent=90, n2=3)
    assert {k: v[1] for k, v in got.items()} == want
    assert len(set(want.values())) > 30


def test_sketches_of_wide_sets_decide(spark, make, monkeypatch):
    monkeypatch.setattr(nj, "WIDE_FROM", 50)
    rng = random.Random(10)
    rows = family(rng, 40, 120, 3) + [(200 + d, t + " more") for d, t in family(random.Random(10), 10, 120, 3)]
    rows += [(300 + i, " ".join(f"s{i}_{j}" for j in range(30))) for i in range(5)]
    want = jaccard_components({d: shingles(t, 3) for d, t in rows}, 90)
    assert {k: v[1] for k, v in components(make(rows), shingle=3, percent=90, n2=3).items()} == want


def test_written_pairs_grow_with_the_members(spark, make, monkeypatch):
    """A family of unlinked members: what is written to be checked, against members."""
    table_, written = Scratch.table, {}

    def noted(self, df, name):
        out = table_(self, df, name)
        if name in ("pairs", "differences"):
            written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(Scratch, "table", noted)
    per = []
    for members in (60, 240):
        written.clear()
        got = components(make(family(random.Random(11), members, 400, 9)), shingle=3, percent=90, n2=3)
        assert len({c for _, c in got.values()}) == members
        per.append(sum(written.values()) / members)
    assert per[1] <= 2 * max(per[0], 4), per


@pytest.mark.parametrize("percent, n2", [(80, 2), (90, 3)])
def test_few_empty_projections(percent, n2):
    """Unrelated sets of a band hardly share a signature, whatever their size in the band."""
    rng = np.random.default_rng(12)
    for size in (40, 100, 333, 700, 1100):
        sets = [np.unique(rng.integers(0, 2**63, size).astype(np.uint64)) for _ in range(40)]
        idx, sig = nj.signatures(sets, percent, n2)
        pairs = np.unique(np.stack([sig, idx.astype(np.uint64)]), axis=1)
        shared = len(pairs[0]) - len(np.unique(pairs[0]))
        assert shared <= (4 if size >= 100 else 20), (size, shared)


def test_keep_one_per_component(spark, make):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(5, near), (3, near + " z"), (3, near + " z"), (8, "other text here and more"), (9, None), (9, "")]
    kept = nj.keep_one_per_component(make(rows))
    assert kept.columns == make([]).columns
    assert sorted((r["doc_id"], (r["text"] or "")[:5]) for r in kept.collect()) == [
        (3, "w0 w1"), (8, "other"), (9, ""), (9, ""),
    ]


def test_keep_one_where_ids_repeat_with_other_texts(spark, make):
    """One row of each component stays, also where an id has one row in each of two."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(3, a), (5, a + " z"), (3, b), (1, b + " z"), (7, b.upper()), (3, "")]
    kept = nj.keep_one_per_component(make(rows))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(3, a), (1, b + " z"), (3, "")])


def test_plan_has_no_pairs_of_everything(spark, make):
    plan = nj.ngram_components(make([(1, "a b c d e f"), (2, "a b c d e f")]))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_component_goes_through_one_window(spark, make, monkeypatch):
    """The least document of a component is an aggregate, not a window over its classes."""
    plans = []
    table_ = Scratch.table

    def noted(self, df, name):
        if name in ("several", "least", "classes"):
            plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return table_(self, df, name)

    monkeypatch.setattr(Scratch, "table", noted)
    near = " ".join(f"w{i}" for i in range(60))
    rows = [(9 - d, f"{near} z{d}") for d in range(6)] + [(20, "x y z a b")]
    got = {d: c for d, (_, c) in components(make(rows), shingle=3, percent=90, n2=3).items()}
    assert got == {d: 4 for d in range(4, 10)} | {20: 20}
    assert plans and not any("Window" in p for _, p in plans)


def test_each_table_first_lets_go_what_came_before(spark, make, monkeypatch):
    """A driver of 1500 MB ran out of memory on what steps had left behind; tables that a check
    needs go with it."""
    table_, release, calls, roots = Scratch.table, Scratch.release, [], set()

    def noted(self, df, name):
        calls.append(name)
        roots.add(self.root)
        return table_(self, df, name)

    monkeypatch.setattr(Scratch, "table", noted)
    monkeypatch.setattr(Scratch, "release", lambda self: calls.append(None) or release(self))
    rows = family(random.Random(11), 12, 120, 3) + [(100, "x y z a b")]
    got = components(make(rows), shingle=3, percent=90, n2=3)
    assert {k: v[1] for k, v in got.items()} == jaccard_components({d: shingles(t, 3) for d, t in rows}, 90)
    names = [i for i, c in enumerate(calls) if c]
    assert len(names) > 10 and all(calls[i + 1 : i + 2] == [None] for i in names)
    (root,) = roots
    left = {x.split("-", 1)[1] for x in os.listdir(root.removeprefix("file:").replace("//", "/"))}
    assert "classes" in left and not left & {"may", "wanted", "carriers", "sets", "direct", "refined", "star"}


def test_many_signatures_are_dealt_out_in_parts(spark, make, monkeypatch):
    """Disk: of many signatures, no shuffle has more than a part, and it goes when its table is
    written; the buckets are those of all signatures at once."""
    bucket_members, table_, dealt, tables = nj.bucket_members, Scratch.table, [], {}

    def parts(sigs):
        dealt.append(sigs)
        return bucket_members(sigs)

    def noted(self, df, name):
        out = table_(self, df, name)
        if name in ("signed", "buckets"):
            tables[name] = out.collect()
        if name in ("part", "buckets"):
            tables.setdefault("go", []).append((name, self.shuffles_go))
        return out

    monkeypatch.setattr(nj, "bucket_members", parts)
    monkeypatch.setattr(Scratch, "table", noted)
    rows = [(100 * k + d, t.replace("b", f"b{k}_")) for k in range(3) for d, t in family(random.Random(k), 12, 150, 2 + k)]
    rows += [(900 + i, f"own {i} text {i} of a few {i} words") for i in range(40)] + [(950, None), (951, "")]
    want = jaccard_components({d: shingles(t or "", 3) for d, t in rows}, 90)

    def buckets():
        dealt.clear()
        tables.clear()
        got = components(make(rows), shingle=3, percent=90, n2=3)
        assert {d: c for d, (_, c) in got.items()} == want
        return sorted(map(tuple, tables["buckets"]))

    at_once = buckets()
    assert len(dealt) == 1 and tables["go"] == [("buckets", True)] and at_once
    monkeypatch.setattr(nj, "ONE_SHUFFLE", 0)
    # What is dealt out is read from tables that go: its size is taken when it is.
    sizes = []
    monkeypatch.setattr(nj, "bucket_members", lambda sigs: sizes.append(sigs.count()) or parts(sigs))
    assert buckets() == at_once
    n = len(nj.SIG_COLUMNS)
    signed = sum(r["sigs"] for r in tables["signed"])
    assert len(sizes) == n > 2 and sum(sizes) == signed and max(sizes) < signed * 2 / n
    assert all(r["sigs"] == sum(len(r[c]) for c in nj.SIG_COLUMNS) for r in tables["signed"])
    assert tables["go"] == [("part", True)] * n + [("buckets", True)]


def test_parameters_are_checked(spark, make):
    with pytest.raises(ValueError):
        nj.ngram_components(make([]), percent=20)
