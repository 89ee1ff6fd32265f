"""Language identification of mixed-language text.

**Learning.** Over all labelled rows, each task counts hashed character trigrams
(lower case, word boundaries included) and letters per script, by language; Spark
adds the counts up. The model is one table of languages by buckets, whose size does
not depend on the corpus.

**Prediction.** A word's score for a language is the sum of its trigrams' log
probabilities. The word's script narrows the candidates to languages that were
learned with that script; where none was, the word says nothing. Viterbi over the
words of a text, with a penalty for switching the language between neighbouring
words, labels spans. Texts of a block advance together, word by word, in numpy.
The predicted language has most letters in the spans; the score is its share of
letters times its posterior probability over all words.

Edge cases: null texts and texts without a letter are ``und`` with score 0. Ties go
to the language that sorts first. With nothing to learn from every text with a
letter is ``und`` too. Repeated rows are predicted alike; extra columns pass
through. Texts are read whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import lower_case, separated, text_blocks
from .common import own_names

#: Trigram buckets of the model.
BUCKETS = 1 << 15
#: Cost, in nats, of switching the language between two words.
SWITCH = 12.0
#: Added to every count.
SMOOTHING = 0.1
#: Least share of a language's letters that makes a script one of its own.
SCRIPT_SHARE = 0.01
#: Words that advance together; bounds a task's memory.
GROUP_WORDS = 1_000_000

# Script of a character by its first UTF-8 byte: fixed Unicode block ranges.
SCRIPT_RANGES = [
    (0x41, 0x5A, 1),  # Latin
    (0x61, 0x7A, 1),
    (0xC3, 0xCA, 1),  # Latin with marks
    (0xCD, 0xCF, 2),  # Greek
    (0xD0, 0xD4, 3),  # Cyrillic
    (0xD5, 0xD5, 4),  # Armenian
    (0xD6, 0xD7, 5),  # Hebrew
    (0xD8, 0xDD, 6),  # Arabic and Syriac
    (0xE0, 0xE0, 7),  # South Asian
    (0xE1, 0xE1, 8),  # Georgian, Hangul Jamo, Khmer and others
    (0xE3, 0xE3, 9),  # Kana
    (0xE4, 0xE9, 10),  # Han
    (0xEA, 0xED, 11),  # Hangul
    (0xF0, 0xF4, 12),  # supplementary planes
]
N_SCRIPTS = 13
_SCRIPT = np.zeros(256, np.uint8)
for _lo, _hi, _s in SCRIPT_RANGES:
    _SCRIPT[_lo : _hi + 1] = _s

# Bytes of words: lower-case ASCII letters and all of multi-byte characters;
# everything else is a boundary, written as a space.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def _trigrams(c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of word bytes, their trigram bucket, and whether a word starts there."""
    p = np.concatenate((np.array([0x20], np.uint8), c, np.array([0x20], np.uint8)))
    at = np.flatnonzero(c != 0x20)
    a, b, d = (p[at + k].astype(np.uint32) for k in range(3))
    h = a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA77) ^ d * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return at, (h >> np.uint32(17)).astype(np.int64) & (BUCKETS - 1), a == 0x20


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task: (lang, bucket, n); buckets from ``BUCKETS`` on are scripts."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for i, j, off, data in text_blocks(batch, "text"):
            off, data = separated(off, data)
            at, bucket, _ = _trigrams(_FOLD[lower_case(data)])
            of = np.searchsorted(off, at, side="right") - 1
            names = sorted(set(langs[i:j]))
            code = np.array([names.index(x) for x in langs[i:j]])
            tri = np.bincount(code[of] * BUCKETS + bucket, minlength=len(names) * BUCKETS)
            script = np.bincount(code[of] * N_SCRIPTS + _SCRIPT[data[at]], minlength=len(names) * N_SCRIPTS)
            for k, x in enumerate(names):
                own = sums.setdefault(x, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                own[:BUCKETS] += tri[k * BUCKETS : (k + 1) * BUCKETS]
                own[BUCKETS:] += script[k * N_SCRIPTS : (k + 1) * N_SCRIPTS]
    for x, own in sums.items():
        b = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x] * len(b), pa.string()), pa.array(b.astype(np.int64)), pa.array(own[b])],
            names=["lang", "bucket", "n"],
        )


class LanguageModel:
    """Log probabilities ``(languages, buckets)`` and the scripts of each language."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        tri = counts[:, :BUCKETS] + SMOOTHING
        self.log_p = np.log(tri / tri.sum(axis=1, keepdims=True)).astype(np.float32) if langs else None
        scripts = counts[:, BUCKETS:].astype(float)
        scripts[:, 0] = 0  # continuation bytes and signs have no script of their own
        total = np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.uses = scripts / total >= SCRIPT_SHARE


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageModel:
    """The model of all rows of ``docs`` that have a text and a language.

    The driver receives the summed table: languages times buckets, at most."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "text is not null and lang is not null"
    )
    sums = rows.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = sums.toArrow()
    names = sorted(set(got.column("lang").to_pylist()))
    counts = np.zeros((len(names), BUCKETS + N_SCRIPTS))
    if names:
        code = {x: k for k, x in enumerate(names)}
        at = np.array([code[x] for x in got.column("lang").to_pylist()])
        counts[at, got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return LanguageModel(names, counts)


def _word_scores(model: LanguageModel, offsets: np.ndarray, data: np.ndarray):
    """Words of a block: scores per language, letters, the first word of each text, and
    whether a word's script was learned."""
    n_langs = len(model.langs)
    offsets, data = separated(offsets, data)
    at, bucket, begins = _trigrams(_FOLD[lower_case(data)])
    if not len(at):
        none = np.zeros(0, np.int64)
        return np.zeros((0, n_langs), np.float32), none, np.zeros(len(offsets), np.int64), none.astype(bool)
    first = np.flatnonzero(begins)
    scores = np.empty((len(first), n_langs), np.float32)
    for k in range(n_langs):
        scores[:, k] = np.add.reduceat(model.log_p[k][bucket], first)
    letters = np.add.reduceat(((data[at] & 0xC0) != 0x80).astype(np.int64), first)
    # The script of a word is that of its first letter; the first byte tells it.
    script = _SCRIPT[data[at[first]]]
    allowed = model.uses[:, script].T
    some = allowed.any(axis=1)
    scores -= scores.max(axis=1, keepdims=True)
    scores = np.where(allowed, scores, -1e4).astype(np.float32)
    scores -= scores.max(axis=1, keepdims=True)
    scores[~some] = 0
    return scores, letters, np.searchsorted(at[first], offsets), some


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word. Text ``i`` has the words ``first[i]:first[i + 1]``;
    all texts advance together, the long ones alone at the end."""
    n_words, n = scores.shape
    out = np.zeros(n_words, np.int64)
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    if not len(order):
        return out
    start, length = first[:-1][order], length[order]
    active = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
    back = np.empty((n_words, n), np.uint8 if n < 256 else np.uint16)
    stay = np.arange(n, dtype=back.dtype)
    v = scores[start].copy()
    for t in range(1, length[0]):
        m = active[t]
        rows = start[:m] + t
        cur = v[:m]
        arg = cur.argmax(axis=1)
        jump = cur[np.arange(m), arg] - switch
        moved = jump[:, None] > cur
        back[rows] = np.where(moved, arg[:, None], stay)
        best = np.where(moved, jump[:, None], cur) + scores[rows]
        v[:m] = best - best.max(axis=1, keepdims=True)
    state = v.argmax(axis=1)
    for t in range(length[0] - 1, -1, -1):
        m = active[t]
        rows = start[:m] + t
        out[rows] = state[:m]
        if t:
            state[:m] = back[rows, state[:m]]
    return out


def _has_letter(text: str | None) -> bool:
    return any(ch.isalpha() for ch in text or "")


def _spans(names: list[str], path: np.ndarray) -> list[dict]:
    """Runs of one language: first word, number of words."""
    if not len(path):
        return []
    cut = np.concatenate(([0], np.flatnonzero(np.diff(path)) + 1, [len(path)]))
    return [{"lang": names[path[a]], "word": int(a), "words": int(b - a)} for a, b in zip(cut[:-1], cut[1:])]


_SPAN = pa.list_(pa.struct([("lang", pa.string()), ("word", pa.int64()), ("words", pa.int64())]))


def _predict(model: LanguageModel, columns: list[str], text_col: str, spans: bool):
    def finish(batch: pa.RecordBatch, parts: list) -> pa.RecordBatch:
        scores = np.concatenate([p[0] for p in parts])
        letters = np.concatenate([p[1] for p in parts])
        some = np.concatenate([p[3] for p in parts])
        sizes = np.cumsum([0] + [len(p[0]) for p in parts])
        first = np.concatenate([p[2][:-1] + s for p, s in zip(parts, sizes)] + [sizes[-1:]])
        path = viterbi(scores, first)
        texts = batch.column(batch.schema.get_field_index(text_col))
        langs, conf, runs = [], [], []
        for i in range(batch.num_rows):
            a, b = first[i], first[i + 1]
            # Signs outside ASCII count as words until here; a letter is mostly found at once.
            if a == b or not _has_letter(texts[i].as_py()):
                langs.append("und")
                conf.append(0.0)
                runs.append([])
                continue
            share = np.bincount(path[a:b], weights=letters[a:b], minlength=len(model.langs))
            k = int(share.argmax())
            total = scores[a:b].sum(axis=0, dtype=np.float64)
            odds = np.exp(np.clip(total - total.max(), -700, 0))
            langs.append(model.langs[k])
            conf.append(float(share[k] / max(share.sum(), 1) * odds[k] / odds.sum()))
            runs.append(_spans(model.langs, path[a:b]) if spans else [])
        extra = [pa.array(langs, pa.string()), pa.array(conf, pa.float64())]
        names = ["lang_pred", "lang_score"]
        if spans:
            extra.append(pa.array(runs, _SPAN))
            names.append("lang_spans")
        kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        return pa.RecordBatch.from_arrays(kept + extra, names=[*columns, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, begin, held = [], 0, 0
            for i, j, off, data in text_blocks(batch, text_col):
                parts.append(_word_scores(model, off, data))
                held += len(parts[-1][0])
                if held >= GROUP_WORDS:
                    yield finish(batch.slice(begin, j - begin), parts)
                    parts, begin, held = [], j, 0
            if parts:
                yield finish(batch.slice(begin), parts)

    return run


@own_names("lang_pred", "lang_score", "lang_spans")
def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", spans: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and, if asked for, ``lang_spans``: runs
    of words of one language (first word, number of words)."""
    more = "lang_pred string, lang_score double"
    if spans:
        more += ", lang_spans array<struct<lang:string,word:long,words:long>>"
    if not model.langs:
        none = F.array().cast("array<struct<lang:string,word:long,words:long>>")
        out = docs.withColumns({"lang_pred": F.lit("und"), "lang_score": F.lit(0.0)})
        return out.withColumn("lang_spans", none) if spans else out
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_predict(model, docs.columns, text_col, spans), f"{schema}, {more}")
