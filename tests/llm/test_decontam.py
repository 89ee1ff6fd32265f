import random

import numpy as np
import pytest

from helpers_llm import MEDIUM, make, table  # noqa: F401
from ohlcflow.llm import decontam as dc


def brute_lcs(a, b):
    t = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, t[j + 1] = t[j + 1], prev + 1 if x == y else max(t[j + 1], t[j])
    return t[-1]


def test_lcs_matches_brute_force():
    rng = random.Random(0)
    for _ in range(300):
        a = [rng.randrange(8) for _ in range(rng.randrange(1, 90))]
        b = [rng.randrange(8) for _ in range(rng.randrange(0, 90))]
        assert dc._lcs(a, b) == brute_lcs(a, b)


def prose(rng, n):
    return " ".join(rng.choice("aeioubdgk") + rng.choice("lmnrst") + rng.choice("aeiou") + rng.choice("ptkdx") for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    items = [(i, prose(rng, 12 + 3 * i) + ". " + prose(rng, 4) + ".") for i in range(12)]
    docs = [(d, prose(rng, rng.randrange(20, 600))) for d in range(300)]
    planted = {}
    for d, (i, text) in enumerate(items):
        w = docs[d][1].split()
        at = rng.randrange(len(w))
        body = text.split()
        if d % 2:  # a paraphrase: every sixth word is another
            body = [x if k % 6 or k > len(body) - 6 else prose(rng, 1) for k, x in enumerate(body)]
        docs[d] = (d, " ".join(w[:at] + body + w[at:]).upper() if d % 3 == 0 else " ".join(w[:at] + body + w[at:]))
        planted[d] = i
    docs.append((500, items[0][1]))
    planted[500] = 0
    return docs, items, planted


def test_planted_items_are_found_and_clean_texts_are_not(spark, make, corpus):
    docs, items, planted = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(make(docs), bench).collect()}
    assert got == set(planted.items())
    kept = {r["doc_id"] for r in dc.clean_documents(make(docs), bench).collect()}
    assert kept == {d for d, _ in docs} - set(planted)


def test_verbatim_items_of_documents(spark):
    docs, bench = (table(spark, t, MEDIUM) for t in ("documents", "benchmark"))
    flat = lambda t: " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split())
    items = {r["item_id"]: flat(r["text"]) for r in bench.collect()}
    want = {(r["doc_id"], i) for r in docs.collect() for i, t in items.items() if f" {t} " in f" {flat(r['text'])} "}
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(docs.select("doc_id", "text"), bench).collect()}
    assert len(want) > 10 and want <= got
    assert len(got - want) <= len(want) * 0.05


def disguised(rng, items, item, how):
    """Another word in place of this share of the words outside the answer (0: a foreign word
    after every word instead), and whether the check accepts that."""
    words_, answer = items.words[item], len(items.answers[item])
    cut = len(words_) - answer
    text = ITEM_WORDS[item]
    gone = set(rng.sample(range(cut), round(how * cut))) if how else set()
    out = [prose(rng, 1) if k in gone else x for k, x in enumerate(text)]
    if not how:
        out = [y for x in out for y in (x, prose(rng, 1))]
    h = dc._Items._hash(" ".join(out)).view(np.int64).tolist()
    share = brute_lcs(words_, h) / len(words_)
    told = brute_lcs(items.answers[item], h) / answer
    return " ".join(out), share >= dc.VERBATIM or share >= dc.PARAPHRASE and told >= dc.ANSWER


ITEM_WORDS: dict[int, list[str]] = {}


def test_whatever_the_check_accepts_is_found(spark, make):
    """Paraphrases of benchmark items inside documents, down to half of the item's words."""
    rng = random.Random(7)
    bench = table(spark, "benchmark", MEDIUM)
    rows = sorted(tuple(r) for r in bench.select("item_id", "text").collect())
    clean = table(spark, "documents", MEDIUM).where("length(text) > 500").orderBy("doc_id").limit(400)
    clean = [r["text"].split() for r in clean.collect()]
    items = dc._Items([i for i, _ in rows], [t for _, t in rows], dc.LatentSpace(np.ones((dc.DIMENSIONS, 2))))
    flat = lambda t: "".join(c if c.isalnum() else " " for c in t).split()
    ITEM_WORDS.update({k: flat(t) for k, (_, t) in enumerate(rows)})
    docs, want = [], set()
    for how in (0, 0.2, 0.4, 0.5, 0.6):
        for k in range(len(rows)):
            assert len(ITEM_WORDS[k]) == len(items.words[k])
            text, accepted = disguised(rng, items, k, how)
            w = rng.choice(clean)
            at = rng.randrange(len(w))
            docs.append((len(docs), " ".join(w[:at] + [text] + w[at:])))
            if accepted:
                want.add((len(docs) - 1, rows[k][0]))
    assert len(want) > 4 * len(rows)
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(make(docs), bench).collect()}
    assert want <= got


def test_stretches_of_a_long_text(spark, make, monkeypatch):
    """Counted a few at a time, and with an item across what is counted together."""
    monkeypatch.setattr(dc, "COUNT_CELLS", 5)
    rng = random.Random(3)
    item = prose(rng, 30)
    docs = [(d, prose(rng, 100 + 7 * d) + " " + " ".join(f"{x} {prose(rng, 1)}" for x in item.split())) for d in range(12)]
    df, bench = make(docs), spark.createDataFrame([(1, item), (2, prose(rng, 25))], "item_id long, text string")
    assert sorted(r["doc_id"] for r in dc.contaminated(df, bench).collect()) == list(range(12))


@pytest.mark.parametrize("words", [1, 300, 1 << 18])
def test_words_in_common_of_all_stretches_at_once(monkeypatch, words):
    """Every window with enough of an item's words, repeated ones too, without a look-up for
    each stretch and item."""
    monkeypatch.setattr(dc, "WINDOW_WORDS", words, raising=False)
    rng = random.Random(4)
    some = [prose(rng, 1) for _ in range(12)]
    texts = [" ".join(rng.choice(some) for _ in range(n)) for n in (9, 14, 20, 20, 33)]
    items = dc._Items(list(range(5)), texts, dc.LatentSpace(np.ones((64, 3))))
    docs = [" ".join(rng.choice(some + [prose(rng, 1)] * 9) for _ in range(rng.randrange(1, 90))) for _ in range(25)]
    raw = [d.encode() for d in docs]
    off = np.cumsum([0, *map(len, raw)])
    h, first = dc._hashed_words(off, np.frombuffer(b"".join(raw), np.uint8))
    w = dc.signed(h).tolist()
    want = []
    for group in items.overlaps:
        for it, span in zip(group.part.tolist(), group.spans.tolist()):
            times = items.times[it]
            for t in range(len(docs)):
                for at in range(first[t], first[t + 1]):
                    near = dc.Counter(w[at : min(at + span, first[t + 1])])
                    n = sum(min(near[x], times[x]) for x in times)
                    if w[at] in times and n >= dc._least(len(items.words[it])):
                        want.append((t, it, at, n))
    calls, got = [], []
    places = dc._Items.places
    monkeypatch.setattr(dc._Items, "places", lambda *a: calls.append(1) or places(*a))
    windows = dc._windows
    monkeypatch.setattr(dc, "_windows", lambda *a: (got.append(x) or x for x in windows(*a)))
    batch = dc.pa.RecordBatch.from_arrays([dc.pa.array(docs)], names=["text"])
    list(dc._find(items, [], "text")(iter([batch])))
    assert sorted((t, it, at, n) for t, it, at, _, _, n in got) == sorted(want) and want
    assert words < 1 << 18 or len(calls) == len(items.overlaps)


def test_sketch_gives_the_leading_directions(spark):
    """Singular values and subspace against a dense decomposition."""
    rng = random.Random(2)
    topics = [[prose(rng, 1) for _ in range(40)] for _ in range(5)]
    rows = [(i, " ".join(rng.choice(topics[i % 5]) for _ in range(64))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    space = dc.latent_space(docs, dims=512, rank=5, more=8)
    a = np.zeros((400, 512))
    for k, (_, t) in enumerate(rows):
        raw = np.frombuffer(t.encode(), np.uint8)
        h, _ = dc._hashed_words(np.array([0, len(raw)]), raw)
        np.add.at(a[k], dc._dims(h, 512), 1)
    idf = np.log((400 + 1) / ((a > 0).sum(axis=0) + 0.5))
    a *= idf
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    _, s, v = np.linalg.svd(a, full_matrices=False)
    q, _ = np.linalg.qr(space.weights / np.where(idf > 0, idf, 1)[:, None])
    # Cosines of the principal angles between the two leading subspaces.
    angles = np.linalg.svd(q.T @ v[:5].T, compute_uv=False)
    assert angles.min() > 0.95 and s[4] > s[5]


def test_edge_cases(spark, make):
    bench = spark.createDataFrame(
        [(1, "alpha beta gamma"), (2, None), (None, "x"), (3, ""), (4, "one two three four five six seven eight nine ten"),
         (5, "one two three four five six seven eight nine ten")],
        "item_id long, text string",
    )
    rows = [
        (1, None), (2, ""), (3, "alpha beta gamma"), (4, "alpha x beta gamma"), (5, "Say: Alpha, beta; GAMMA!"),
        (6, "one two three four five six seven eight nine ten"), (6, "one two three four five six seven eight nine ten"),
        (7, "filler words " * 30_000), (None, "so alpha beta gamma it is"),
    ]
    got = sorted(str((r["doc_id"], r["item_id"])) for r in dc.contaminated(make(rows), bench).collect())
    assert got == sorted(str(x) for x in [(3, 1), (5, 1), (6, 4), (6, 5), (6, 4), (6, 5), (None, 1)])
    df = make(rows)
    clean = dc.clean_documents(df, bench)
    assert clean.columns == df.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [1, 2, 4, 7]
    assert dc.contaminated(make([]), bench).collect() == []
    assert dc.contaminated(make(rows), bench.limit(0)).collect() == []


def test_benchmark_bound(spark, make):
    bench = spark.createDataFrame([(i, "some item text") for i in range(5)], "item_id long, text string")
    with pytest.raises(ValueError):
        dc.contaminated(make([(1, "a b c")]), bench, max_items=4)


def test_words_of_items_looked_up_without_a_table(spark, make, corpus, monkeypatch):
    """Items by words beyond the table's bound: the same rows."""
    docs, items, _ = corpus
    bench = spark.createDataFrame(items + [(99, " ".join(items[3][1].split()[:9] * 2))], "item_id long, text string")
    space = dc.latent_space(make(docs))
    got = lambda: sorted(map(tuple, dc.contaminated(make(docs).select("doc_id", "text"), bench, space).collect()))
    with_table = got()
    monkeypatch.setattr(dc, "SLOT_CELLS", 0)
    assert got() == with_table and with_table
