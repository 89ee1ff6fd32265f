import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers_llm import MEDIUM, make, table  # noqa: F401
from ohlcflow.llm import langid
from ohlcflow.llm.queries import op2_language_id


def brute_viterbi(scores, switch):
    n = scores.shape[1]
    best = max(
        product(range(n), repeat=len(scores)),
        key=lambda p: sum(scores[i, k] for i, k in enumerate(p)) - switch * sum(a != b for a, b in zip(p, p[1:])),
    )
    return list(best)


def value(scores, path, switch):
    return sum(scores[i, k] for i, k in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))


def test_viterbi_matches_brute_force():
    rng = np.random.default_rng(0)
    lengths = [0, 1, 5, 7, 0, 3, 6]
    scores = rng.normal(0, 4, (sum(lengths), 3)).astype(np.float32)
    first = np.concatenate(([0], np.cumsum(lengths)))
    path = langid.viterbi(scores, first, 2.5)
    for a, b in zip(first[:-1], first[1:]):
        if b > a:
            best = brute_viterbi(scores[a:b], 2.5)
            assert value(scores[a:b], path[a:b], 2.5) == pytest.approx(value(scores[a:b], best, 2.5), abs=1e-3)


def test_held_out_accuracy(spark):
    lang = table(spark, "documents", MEDIUM).select("doc_id", "lang")
    rows = op2_language_id(spark, MEDIUM).join(lang, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == lang.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


LEARN = [
    (1, "the cat and the dog were there with them", "en"), (2, "this is what they think of the weather", "en"),
    (3, "der hund und die katze waren nicht dort", "de"), (4, "das ist was sie über das wetter denken", "de"),
    (5, "это то что они думают о погоде", "ru"), (6, "кошка и собака были там", "ru"),
    (7, "no language", None), (8, None, "en"),
]


@pytest.fixture(scope="module")
def model(spark):
    return langid.learn(spark.createDataFrame(LEARN, "doc_id long, text string, lang string"))


def test_spans_of_mixed_text(spark, make, model):
    text = "the cat and the dog were there " * 3 + "это то что они думают " * 3 + "der hund und die katze waren nicht " * 3
    row = langid.identify(make([(1, text)]), model).first()
    assert [s["lang"] for s in row["lang_spans"]] == ["en", "ru", "de"]
    assert [s["words"] for s in row["lang_spans"]] == [21, 15, 21]
    assert [s["word"] for s in row["lang_spans"]] == [0, 21, 36]


def test_script_narrows_candidates(spark, make, model):
    rows = [(1, "погода"), (2, "кошка der"), (3, "WEATHER the"), (4, "ÜBER DAS WETTER")]
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(make(rows), model).collect()}
    assert got == {1: "ru", 2: "ru", 3: "en", 4: "de"}


def test_edge_cases(spark, make, model):
    rows = [
        (1, None), (2, ""), (3, "123 !? 4.5"), (4, "— … ©"), (5, "×"), (6, "漢字"), (7, "a"), (7, "a"), (None, "the"),
        (8, "the dog " * 60_000), (9, "\x00the\x00dog"),
    ]
    df = make(rows)
    out = langid.identify(df, model).collect()
    got = {}
    for r in out:
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["lang_score"]))
    assert all(got[i] == [("und", 0.0)] for i in (1, 2, 3, 4, 5))
    assert got[6][0][0] in model.langs and got[7][0] == got[7][1]
    assert got[None][0][0] == "en" and got[8][0][0] == "en" and got[9][0][0] == "en"
    added = ["lang_pred", "lang_score", "lang_spans"]  # in place of the caller's
    assert langid.identify(df, model).columns == [c for c in df.columns if c not in added] + added
    assert langid.identify(make([]), model).collect() == []


def test_nothing_to_learn_from(spark, make):
    empty = langid.learn(spark.createDataFrame([], "text string, lang string"))
    row = langid.identify(make([(1, "the dog")]), empty).first()
    assert (row["lang_pred"], row["lang_score"], row["lang_spans"]) == ("und", 0.0, [])


def test_counts_are_of_all_rows(spark):
    """Counts of the model against a plain count of the same trigrams."""
    docs = spark.createDataFrame([(i, "ab c", "x") for i in range(500)], "doc_id long, text string, lang string")
    sums = docs.select("text", "lang").mapInArrow(langid._count, "lang string, bucket long, n long")
    total = sums.where(F.col("bucket") < langid.BUCKETS).agg(F.sum("n")).first()[0]
    assert total == 500 * 3  # one trigram per letter


def test_texts_of_signs_have_no_language(spark):
    """Signs that share their first byte with letters of a learned script are no letters."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("él está aquí mañana señor año", "es"), ("これはテストです。ありがとう", "ja"), ("это не так просто", "ru")] * 5)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    signs = ["× × × × × ×", "÷÷÷÷÷÷ ÷÷", "。。 。 。、", "١٢٣ ×÷", "… — „“ №"]
    got = langid.identify(spark.createDataFrame([(t,) for t in signs + ["×× mañana", "。これ"]], "text string"), model).collect()
    assert [(r["lang_pred"], r["lang_score"]) for r in got[:5]] == [("und", 0.0)] * 5
    assert [r["lang_pred"] for r in got[5:]] == ["es", "ja"]
