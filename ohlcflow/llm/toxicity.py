"""Toxicity of texts whose words may be disguised.

**Noisy channel.** Tokens that mix letters with look-alike digits and signs, repeat a
letter three times or more, or are spelled out letter by letter are decoded: every
character becomes the letters it may stand for (a separator: none; a run: one or two
letters), each at the channel's cost, and Viterbi over this lattice finds the likeliest
letters under a character trigram model of the corpus. The best few paths are ranked
again with a word model (words that several documents use). All other tokens have
one path through the lattice, themselves.

**Score.** Features of a restored text are its words and their prefixes of some lengths.
Those that mark toxic rows significantly (by information, near copies counted once) make
a weighted lexicon; a word weighs as the longest of its features that is in there. A
logistic model over the strongest weight, the sum and the number of the words that weigh,
and the text's length gives the score.

**What is learned from what.** The character and the word model count over all documents.
A word model of more than ``BROADCAST_WORDS`` words stays a table, and only those of its
words that disguised words of the documents at hand may be are joined out of it. The lexicon
and the logistic model are fitted on a sample of labelled rows, at most
``SAMPLE_PER_CLASS`` of each label, chosen by a hash of their id; its bound makes it a
broadcast side.

Edge cases: null and empty texts have no feature and the model's score for none. Without
toxic labels every score is 0. Labels that are null, or of ids that are not there, are
ignored; of repeated ids the larger label counts. Texts are read whole. Extra columns pass
through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import lower_case, mix, prefix_sums, separated, signed, span_hashes, text_blocks, word_hashes, words
from .common import own_names, release, scratch

#: Labelled rows of each label that the lexicon and the logistic model are fitted on.
SAMPLE_PER_CLASS = 4000
#: Most features the lexicon may have.
LEXICON_SIZE = 5000
#: Documents, near copies counted once, that a word of the word model is in; words up to which
#: the model goes to every task (8 bytes each), larger ones are joined by hash.
WORD_ROWS, BROADCAST_WORDS = 3, 4_000_000
#: Nats of evidence a feature needs, and the distinct toxic rows it must occur in.
EVIDENCE, MIN_ROWS = 14.0, 4.0
#: Bytes of the prefixes that are features.
PREFIXES = (4, 5, 6, 8, 10)
#: Longer tokens are split at signs, and what is still longer is decoded in pieces of this
#: length that overlap by half; a run of one character counts as three at most.
LONGEST_TOKEN = 40

# --- Fixed values: letters that a sign or digit may stand for. ---
LOOK_ALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "*": "aeiou",
}
#: Signs that may stand between the letters of a word.
SEPARATORS = " .-_*~'"
#: Costs of the channel, in nats.
COST_LOOK_ALIKE, COST_KEEP, COST_WILD, COST_COLLAPSE, COST_DROP = 0.7, 6.0, 2.0, 0.7, 1.0
#: Most separators between the letters of a spelled-out word.
SPELLED_GAP = 5
#: Letters that are looked at from each letter of a spelled-out run.
SPELLED_WORD = 10
#: Bonus of a path that is a word of the word model.
WORD_BONUS = 6.0
#: Paths kept per state, and paths ranked again at the end.
PATHS, RANKED = 3, 16

#: Bytes of text that a task restores at a time; it holds some fifty times as much meanwhile.
MAP_BYTES = 1 << 18

_U = np.uint64
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True
_ASCII_LETTER = _LETTER.copy()
_ASCII_LETTER[0x80:] = False
_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c in LOOK_ALIKES]] = True
_TAIL = np.zeros(256, bool)
_TAIL[[ord(c) for c in "0123456789@$"]] = True
_SEP = np.zeros(256, bool)
_SEP[[ord(c) for c in SEPARATORS] + [0x0A, 0x09]] = True
_SIGN = ~(_LETTER | _LEET)
_SIGN[0x30:0x3A] = False
_JOIN = np.zeros(256, bool)
_JOIN[[ord(c) for c in "-_~."]] = True
_JOINS = re.compile(r"[-_~.]+")
_GAPS = re.compile(r"[\s._~'-]+")
_LONG_RUN = re.compile(r"(.)\1{3,}", re.DOTALL)
_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in ".,;:?!\"')]}"]] = True
# Classes of the character model: 0 boundary, 1-26 letters, 27 other letters.
_CLASS = np.zeros(256, np.uint16)
_CLASS[0x61:0x7B] = np.arange(1, 27)
_CLASS[0x80:] = 27
N_CLASSES = 28


def _class_of(ch: str) -> int:
    return ord(ch) - 96 if "a" <= ch <= "z" else 27 if ch.isalpha() else 0


# ---------------------------------------------------------------- learning


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character trigrams of a task's words: (gram, n)."""
    total = np.zeros(N_CLASSES**3, np.int64)
    for batch in batches:
        for _, _, off, data in text_blocks(batch, "text"):
            # Narrow types: a block of bytes takes a few times its size here.
            c = _CLASS[lower_case(data)]
            c = c[(data & 0xC0) != 0x80]  # a multi-byte letter counts once
            p = np.concatenate((np.zeros(2, np.uint16), c, np.zeros(1, np.uint16)))
            a, b, d = p[:-2], p[1:-1], p[2:]
            # Before a word's first letter there is only the boundary.
            a = np.where(b == 0, np.uint16(0), a)
            gram = ((a * N_CLASSES + b) * N_CLASSES + d)[(b != 0) | (d != 0)]
            for k in range(0, len(gram), MAP_BYTES):
                total += np.bincount(gram[k : k + MAP_BYTES], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probability of a character class after two others, from all documents.

    The driver receives at most ``N_CLASSES ** 3`` sums."""
    sums = (
        docs.select(F.col(text_col).alias("text"))
        .mapInArrow(_count_trigrams, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    n = np.zeros(N_CLASSES**3)
    n[sums.column("gram").to_numpy()] = sums.column("n").to_numpy()
    n = n.reshape(N_CLASSES, N_CLASSES, N_CLASSES)
    # Interpolated with shorter contexts, so that unseen trigrams keep an order.
    two = n.sum(axis=0)
    one = two.sum(axis=0)
    p1 = (one + 1) / (one + 1).sum()
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (n + 5 * p2[None]) / (n.sum(axis=2, keepdims=True) + 5)
    return np.log(p3)


#: Pairs of a word and a cluster that a task holds before it folds them, and that it may keep.
HELD_PAIRS = 2_000_000


def _folded(h: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, of each word the first ``WORD_ROWS``: as many as decide."""
    order = np.lexsort((cluster, h))
    h, cluster = h[order], cluster[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (cluster[1:] != cluster[:-1])
    h, cluster = h[new], cluster[new]
    start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    few = np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h)))) < WORD_ROWS
    return h[few], cluster[few]


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, cluster) rows: each word of a task with the clusters of the texts it is in, as
    many as decide that it is in ``WORD_ROWS`` of them. Pairs are folded over the blocks of a task,
    so a common word is sent a few times a task; a task that has too many words sends what it has
    and begins anew."""

    def rows(h: np.ndarray, cluster: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(h), 100_000):
            part = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(h[part])), pa.array(signed(cluster[part]))], names=["word", "cluster"]
            )

    held: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0
    for batch in batches:
        for _, _, off, data in text_blocks(batch, "text"):
            off, low = separated(off, lower_case(data))
            s, e, first = words(off, low, _LETTER)
            if not len(s):
                continue
            h = span_hashes(prefix_sums(low), s, e)
            of = np.repeat(np.arange(len(off) - 1), np.diff(first))
            held.append(_folded(h, _near_copies(h, of, len(off) - 1)[of]))
            n += len(held[-1][0])
            if n > HELD_PAIRS:
                held = [_folded(*(np.concatenate(x) for x in zip(*held)))]
                n = len(held[0][0])
                if n > HELD_PAIRS // 2:
                    yield from rows(*held[0])
                    held, n = [], 0
    if held:
        yield from rows(*_folded(*(np.concatenate(x) for x in zip(*held))))


def word_table(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word)``: hashes of the words that at least ``WORD_ROWS`` documents of ``docs`` use."""
    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(_word_rows, "word long, cluster long")
    per = rows.distinct().groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return per.where(F.col("n") >= WORD_ROWS).select("word")


# ---------------------------------------------------------------- decoding


class Decoder:
    """Viterbi over character lattices under the character and word models."""

    def __init__(self, log_p: np.ndarray, known_words: np.ndarray):
        self._made_of = (log_p, known_words)
        self.log_p = log_p.tolist()
        self.known = np.sort(known_words)
        self.decode = lru_cache(maxsize=50_000)(self._decode)

    def __reduce__(self):
        return Decoder, self._made_of

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """Units of a token, each with its options (letters, cost)."""
        units, i = [], 0
        while i < len(token):
            j = i
            while j < len(token) and token[j] == token[i]:
                j += 1
            ch, run = token[i], j - i
            options = {}
            if ch.isalpha():
                options[ch] = 0.0 if run == 1 else COST_COLLAPSE
                if run > 1:
                    options[ch * 2] = 0.0 if run == 2 else COST_COLLAPSE
            for k, x in enumerate(LOOK_ALIKES.get(ch, "")):
                cost = (COST_WILD if ch == "*" else COST_LOOK_ALIKE) + 0.3 * k
                options[x] = cost + (COST_COLLAPSE if run > 1 else 0)
                if run > 1:
                    options[x * 2] = cost + COST_COLLAPSE
            if ch in SEPARATORS or ch.isspace():
                options[""] = COST_DROP
            if not ch.isalnum():
                options.setdefault("", COST_KEEP)
            if not options:
                options[""] = COST_KEEP
            units.append(list(options.items()))
            i = j
        return units

    def ranked(self, token: str) -> list[tuple[float, str]]:
        """The best paths of a lower-case token under the character model."""
        states = {(0, 0): [(0.0, "")]}
        for unit in self.lattice(token):
            nxt: dict = {}
            for (a, b), paths in states.items():
                for letters, cost in unit:
                    x, y, add = a, b, -cost
                    for ch in letters:
                        z = _class_of(ch)
                        add += self.log_p[x][y][z]
                        x, y = y, z
                    nxt.setdefault((x, y), []).extend((s + add, p + letters) for s, p in paths)
            states = {k: sorted(v, reverse=True)[:PATHS] for k, v in nxt.items()}
        ends = [(s + self.log_p[a][b][0], p) for (a, b), paths in states.items() for s, p in paths if p]
        return sorted(ends, reverse=True)[:RANKED]

    def _decode(self, token: str) -> str:
        """The likeliest letters of a lower-case token."""
        ends = self.ranked(token)
        if not ends:
            return token
        known = self._known(_string_hashes([p for _, p in ends]))
        return max((s + WORD_BONUS * k, p) for (s, p), k in zip(ends, known))[1]

    def _known(self, hashes: list[int]) -> list[bool]:
        if not len(self.known):
            return [False] * len(hashes)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return (self.known[at] == hashes).tolist()


class _Listing(Decoder):
    """Leaves tokens as they are, and lists the words they may be."""

    def __init__(self, decoder: Decoder):
        super().__init__(*decoder._made_of)
        self.tokens: set[str] = set()
        self.decode = self._list

    def _list(self, token: str) -> str:
        self.tokens.add(token)
        return token

    def listed(self) -> np.ndarray:
        paths = {p for t in self.tokens for _, p in self.ranked(t)}
        self.tokens.clear()
        return np.array(_string_hashes(sorted(paths)), np.int64)


def _listed_words(decoder: Decoder):
    """Hashes of what the suspects of each block may be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listing = _Listing(decoder)
        for batch in batches:
            for _, _, off, data in text_blocks(batch, "text", MAP_BYTES):
                restore(off, data, listing)
                yield pa.RecordBatch.from_arrays([pa.array(listing.listed())], names=["word"])

    return run


def _decoder_for(docs: DataFrame, text_col: str, log_p: np.ndarray, table: DataFrame) -> Decoder:
    """A decoder with those words of ``table`` that suspects of ``docs`` may be: it decodes them
    as one with all words would."""
    text = docs.select(F.col(text_col).alias("text"))
    may = text.mapInArrow(_listed_words(Decoder(log_p, np.zeros(0, np.int64))), "word long").distinct()
    return Decoder(log_p, table.join(may, "word", "left_semi").toArrow().column("word").to_numpy())


def _string_hashes(strings: list[str]) -> list[int]:
    if not strings:
        return []
    parts = [s.encode() for s in strings]
    ends = np.cumsum([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), np.uint8)
    return signed(word_hashes(data, ends - [len(p) for p in parts], ends)).tolist()


def _pieces(token: str) -> list[str]:
    """A token, or overlapping pieces of one that is too long."""
    if len(token) <= LONGEST_TOKEN:
        return [token]
    half = LONGEST_TOKEN // 2
    return [token[k : k + LONGEST_TOKEN] for k in range(0, len(token) - half, half)]


def _split_long(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The block with spaces for the signs inside of tokens that are too long."""
    s, e, _ = words(offsets, data)
    # Bytes that differ from the one before them count; a run is a few at most.
    kind = np.cumsum(np.concatenate(([True], data[1:] != data[:-1])))
    long = np.flatnonzero((e - s > LONGEST_TOKEN) & (kind[e - 1] - kind[s] >= LONGEST_TOKEN // 3))
    if not len(long):
        return data
    edge = np.zeros(len(data) + 1, np.int64)
    edge[s[long]] += 1
    edge[e[long]] -= 1
    return np.where((np.cumsum(edge[:-1]) > 0) & _SIGN[data], np.uint8(0x20), data)


#: What a suspect is: a token, a token without look-alikes whose parts signs join, letters
#: spelled out.
TOKEN, JOINED, SPELLED = range(3)


def suspects(offsets: np.ndarray, data: np.ndarray) -> list[tuple[int, int, int]]:
    """Byte spans of a block (lower case) that may be disguised words, in order, and their kind."""
    n = len(data)
    if n < 2:
        return []
    letter, leet = _LETTER[data], _LEET[data]
    z = np.zeros(4, bool)
    # A few bytes of padding make the neighbours of every position addressable.
    L, X = np.concatenate((z, letter, z)), np.concatenate((z, leet, z))
    at = lambda v, k: v[4 + k : 4 + k + n]
    inner = leet & at(L, -1) & (at(L, 1) | (at(X, 1) & (at(L, 2) | (at(X, 2) & at(L, 3)))))
    s, e, _ = words(offsets, _split_long(offsets, data))
    head = np.zeros(n, bool)
    head[s] = leet[s] & (at(L, 1)[s] | (at(X, 1)[s] & at(L, 2)[s])) & at(L, 2)[s]
    # The last bytes of a token, before closing punctuation.
    last = e - 1
    for _ in range(3):
        back = _EDGE[data[np.maximum(last, 0)]] & (last > s)
        last = last - back
    tail = np.zeros(n, bool)
    T = np.concatenate((z, _TAIL[data], z))
    tail[last] = at(T, 0)[last] & (
        (at(L, -1)[last] & at(L, -2)[last]) | (at(T, -1)[last] & at(L, -2)[last] & at(L, -3)[last])
    )
    tail[last] &= last - s >= 3
    # Signs, not digits, at the end of a short word.
    M = np.concatenate((z, (data == 0x24) | (data == 0x40), z))
    tail[last] |= at(M, 0)[last] & (at(M, -1)[last] | at(L, -1)[last]) & at(L, -2)[last] & (last - s == 2)
    same = np.zeros(n, bool)
    same[2:] = letter[2:] & (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (data[2:] < 0x80)
    hit = np.flatnonzero(inner | head | tail | same)
    found = set(np.searchsorted(s, hit, side="right") - 1) if len(hit) else set()
    spans = [(int(s[w]), int(e[w]), TOKEN) for w in found]
    J = np.concatenate((z, _JOIN[data], z))
    inside = np.flatnonzero(at(J, 0) & at(L, -1) & at(L, 1))
    if len(inside):
        joined = np.unique(np.searchsorted(s, inside, side="right") - 1)
        joined = joined[(inside[0] >= s[0]) & (e[joined] - s[joined] <= LONGEST_TOKEN)]
        spans += [(int(s[w]), int(e[w]), JOINED) for w in joined.tolist() if w not in found]
    # Letters spelled out: single letters or look-alikes, or a few pairs, with separators between.
    sign = _ASCII_LETTER[data] | leet
    sep = _SEP[data] & ~leet | (data == 0x2A)
    S, P = np.concatenate((z, sign, z)), np.concatenate((z | True, sep, z | True))
    single = sign & at(P, -1) & at(P, 1)
    pair = sign & at(P, -1) & at(S, 1) & at(P, 2)
    unit = np.flatnonzero(single | pair)
    if len(unit) >= 3:
        alone = single[unit]
        end = unit + np.where(alone, 1, 2)
        other = np.concatenate(([0], np.cumsum(~sep)))
        gap = unit[1:] - end[:-1]
        text_of = np.searchsorted(offsets, unit, side="right")
        apart = (gap < 1) | (gap > SPELLED_GAP) | (other[unit[1:]] != other[end[:-1]]) | (np.diff(text_of) != 0)
        cut = np.flatnonzero(apart) + 1
        first, after = np.concatenate(([0], cut)), np.concatenate((cut, [len(unit)]))
        singles = np.concatenate(([0], np.cumsum(alone)))
        singles = singles[after] - singles[first]
        k = np.flatnonzero((singles >= 3) & (2 * singles >= after - first))
        lo, hi = unit[first[k]], end[after[k] - 1]
        letters = np.concatenate(([0], np.cumsum(_ASCII_LETTER[data])))
        some = letters[hi] - letters[lo] >= 3
        lo, hi = lo[some], hi[some]
        if len(lo):
            # Runs follow one another; a span that one overlaps gives way to it.
            a, b = (np.array([x[c] for x in spans], np.int64) for c in range(2))
            next_ = np.searchsorted(hi, a, side="right")
            free = (next_ == len(lo)) | (lo[np.minimum(next_, len(lo) - 1)] >= b)
            spans = [x for x, ok in zip(spans, free.tolist()) if ok]
            spans += [(x, y, SPELLED) for x, y in zip(lo.tolist(), hi.tolist())]
    return sorted(spans)


def restore(offsets: np.ndarray, data: np.ndarray, decoder: Decoder) -> tuple[np.ndarray, np.ndarray]:
    """A block, lower-cased, with every suspect replaced by its decoded letters and a
    space after each text."""
    offsets, low = separated(offsets, lower_case(data))
    parts, at, grown = [], 0, np.zeros(len(offsets), np.int64)
    for a, b, kind in suspects(offsets, low):
        token = low[a:b].tobytes().decode("utf-8", "replace")
        core = _LONG_RUN.sub(r"\1\1\1", token.strip(".,;:?\"')]}("))
        letters = sum(ch.isalpha() for ch in core)
        if letters < 2 and not (letters and core[1:].strip("$@") == ""):
            continue
        if kind == JOINED:
            # The word that the parts may make, besides them.
            new = f"{token} {_JOINS.sub('', core)}"
        elif kind == SPELLED:
            new = [decoder.decode(x) for x in _pieces(_GAPS.sub("", core))]
            # Words spelled out without a gap between them: one may begin at any letter.
            new = " ".join(y for x in new for y in (x, *(x[k : k + SPELLED_WORD] for k in range(1, len(x) - 3))))
        else:
            parts_of = [x for x in _JOINS.split(core) if len(x) > 2]
            new = [decoder.decode(x) for x in _pieces(core)]
            if len(parts_of) > 1:
                new += [decoder.decode(x) for part in parts_of for x in _pieces(part)]
            new = " ".join(new)
        new = new.encode()
        parts += [low[at:a], np.frombuffer(new, np.uint8)]
        grown[np.searchsorted(offsets, a, side="right") :] += len(new) - (b - a)
        at = b
    if not parts:
        return offsets, low
    return offsets + grown, np.concatenate([*parts, low[at:]])


# ---------------------------------------------------------------- features


def _features(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(feature hash, text, word)`` of every prefix, shortest first, then every word, of
    a restored block."""
    # Words are runs of letters here, so punctuation does not make new ones.
    s, e, first = words(offsets, data, _LETTER)
    of = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    sums = prefix_sums(data)
    hs, ws = [], []
    for n in PREFIXES:
        long = np.flatnonzero(e - s > n)
        hs.append(mix(span_hashes(sums, s[long], s[long] + n) + _U(n)))
        ws.append(long)
    hs.append(span_hashes(sums, s, e))
    ws.append(np.arange(len(s)))
    word = np.concatenate(ws)
    return np.concatenate(hs), of[word], word


def _near_copies(words_: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """A one-value MinHash of each text's pairs of neighbouring words."""
    out = np.full(n, np.iinfo(np.uint64).max, _U)
    np.minimum.at(out, of, mix(words_ ^ _U(0x5DEECE66D)))
    pair = of[1:] == of[:-1]
    if pair.any():
        # Texts of one word keep that word's value.
        at = of[1:][pair]
        out[np.unique(at)] = np.iinfo(np.uint64).max
        np.minimum.at(out, at, mix(mix(words_[1:][pair]) + words_[:-1][pair]))
    return out


def _sample_features(decoder: Decoder):
    """(feature, cluster, toxic) rows: the distinct features of each sampled text.
    ``cluster`` is what near copies mostly share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            for i, j, off, data in text_blocks(batch, "text", MAP_BYTES):
                off, low = restore(off, data, decoder)
                h, of, which = _features(off, low)
                if not len(h):
                    continue
                n_words = which.max() + 1
                # The whole words come last.
                cluster = _near_copies(h[-n_words:], of[-n_words:], len(off) - 1)
                order = np.lexsort((h, of))
                h, of = h[order], of[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
                h, of = h[new], of[new]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(h)), pa.array(signed(cluster[of])), pa.array(label[i:j][of])],
                    names=["feature", "cluster", "toxic"],
                )

    return run


class Lexicon:
    """Sorted feature hashes and their weights."""

    def __init__(self, features: np.ndarray, weights: np.ndarray):
        order = np.argsort(features)
        self.features, self.weights = features[order], weights[order]

    def summary(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        """What the logistic model sees of each text."""
        n = len(offsets) - 1
        top, total, number = np.zeros(n), np.zeros(n), np.zeros(n)
        h, of, word = _features(offsets, data)
        length = np.bincount(of[len(h) - (word.max() + 1) :], minlength=n) if len(h) else np.zeros(n)
        if len(self.features) and len(h):
            at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
            hit = np.flatnonzero(self.features[at] == h)
            # Of each word the longest feature: the last one, as they are ordered.
            longest = np.full(word.max() + 1, -1)
            longest[word[hit]] = hit
            pick = longest[longest >= 0]
            pair = np.unique(of[pick] * len(self.features) + at[pick])
            text, w = pair // len(self.features), self.weights[pair % len(self.features)]
            np.maximum.at(top, text, w)
            np.add.at(total, text, w)
            np.add.at(number, text, 1)
        return np.stack([top / 4, np.log1p(total), np.log1p(number), np.log1p(length) / 4 * (number > 0)], axis=1)


class ToxicityModel:
    """``table``: the words of a word model that is too large for the decoder."""

    def __init__(self, decoder: Decoder, lexicon: Lexicon, coef: np.ndarray | None, table: DataFrame | None = None):
        self.decoder, self.lexicon, self.coef, self.table = decoder, lexicon, coef, table

    def of(self, docs: DataFrame, text_col: str) -> ToxicityModel:
        """The model that goes to the tasks that read ``docs``."""
        if self.table is None:
            return self
        decoder = _decoder_for(docs, text_col, self.decoder._made_of[0], self.table)
        return ToxicityModel(decoder, self.lexicon, self.coef)

    def score(self, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        if self.coef is None:
            return np.zeros(len(offsets) - 1)
        off, low = restore(offsets, data, self.decoder)
        x = self.lexicon.summary(off, low)
        # Row by row the same sum, whatever texts share the block.
        return 1 / (1 + np.exp(-(self.coef[0] + (x * self.coef[1:]).sum(axis=1))))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, l2: float = 0.05) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a ridge."""
    a = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(a.shape[1])
    ridge = np.eye(len(b)) * l2
    ridge[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        grad = a.T @ (w * (p - y)) + ridge @ b
        step = np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + ridge, grad)
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    return b


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE_PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """Fit on ``labels`` (id, 0 or 1); characters and words are counted in all of ``docs``."""
    log_p = character_model(docs, text_col)
    with scratch(docs.sparkSession, "toxicity") as work:
        table = work.table(word_table(docs, text_col), "words")
        if table.count() <= BROADCAST_WORDS:
            decoder, large = Decoder(log_p, table.toArrow().column("word").to_numpy()), None
            work.close()
        else:
            decoder, large = Decoder(log_p, np.zeros(0, np.int64)), table
    release(docs.sparkSession)
    one = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic"))
        .where("_id is not null and toxic in (0, 1)")
        .groupBy("_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    n = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    if not n.get(1):
        return ToxicityModel(decoder, Lexicon(np.zeros(0, np.int64), np.zeros(0)), None, large)
    order = F.xxhash64("_id", F.lit("toxicity"))
    picked = one.where("toxic = 1").orderBy(order, "_id").limit(sample)
    picked = picked.union(one.where("toxic = 0").orderBy(order, "_id").limit(sample))
    # At most 2 * sample narrow rows: the bound that allows the broadcast.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "_id")
    rows = rows.select("text", "toxic")
    fit = decoder if large is None else _decoder_for(rows, "text", log_p, large)
    seen = rows.mapInArrow(_sample_features(fit), "feature long, cluster long, toxic int")
    # Dealt by feature once: both aggregations stay where the rows are.
    once = seen.repartition("feature").groupBy("feature", "cluster", "toxic").agg(F.count(F.lit(1)).alias("k"))
    per = once.groupBy("feature").agg(
        F.sum("toxic").cast("double").alias("t"),
        F.sum(1 - F.col("toxic")).cast("double").alias("c"),
    )
    taken = {k: float(min(n.get(k, 0), sample)) for k in (0, 1)}
    t, c = F.col("t"), F.col("c")
    base = taken[1] / (taken[0] + taken[1])
    share = t / (t + c)
    rest = F.when(share < 1, (1 - share) * F.log((1 - share) / F.lit(max(1 - base, 1e-9)))).otherwise(0.0)
    # Nats by which the feature's rows depart from the sample's share of toxic ones.
    evidence = (t + c) * (share * F.log(share / F.lit(base)) + rest)
    weight = F.log((t + 0.5) / F.lit(taken[1] + 1)) - F.log((c + 0.5) / F.lit(taken[0] + 1))
    marks = (
        per.where(t >= MIN_ROWS)
        .select("feature", evidence.alias("evidence"), weight.alias("weight"))
        .where((F.col("evidence") >= EVIDENCE) & (F.col("weight") > 1))
        .orderBy(F.desc("evidence"), "feature")
        .limit(LEXICON_SIZE)
        .toArrow()
    )
    lexicon = Lexicon(marks.column("feature").to_numpy().view(_U), marks.column("weight").to_numpy())
    release(docs.sparkSession)
    sums = rows.mapInArrow(_summaries(fit, lexicon), "x array<double>, toxic int").toArrow()
    x = np.array(sums.column("x").to_pylist()).reshape(-1, 4)
    y = sums.column("toxic").to_numpy().astype(float)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(decoder, lexicon, None, large)
    # Weigh the sample's rows back to the share of their label.
    back = {k: n.get(k, 0) / max(taken[k], 1.0) for k in (0, 1)}
    release(docs.sparkSession)
    return ToxicityModel(decoder, lexicon, _logistic(x, y, np.where(y == 1, back[1], back[0])), large)


def _summaries(decoder: Decoder, lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, off, data in text_blocks(batch, "text", MAP_BYTES):
                x = lexicon.summary(*restore(off, data, decoder))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.tolist(), pa.list_(pa.float64())), batch.column(1).slice(i, j - i)], names=["x", "toxic"]
                )

    return run


def _scored(model: ToxicityModel, columns: list[str], text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, off, data in text_blocks(batch, text_col, MAP_BYTES):
                part = batch.slice(i, j - i)
                kept = [part.column(part.schema.get_field_index(c)) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(model.score(off, data))], names=[*columns, "toxicity"]
                )

    return run


@own_names("toxicity")
def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``toxicity`` from 0 to 1; without the text where it is not wanted."""
    columns = [c for c in docs.columns if keep_text or c != text_col]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in columns)
    return docs.mapInArrow(_scored(model.of(docs, text_col), columns, text_col), f"{schema}, toxicity double")


def _restored(decoder: Decoder, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for i, j, off, data in text_blocks(batch, text_col, MAP_BYTES):
                off, low = restore(off, data, decoder)
                raw = low.tobytes()
                text = [raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:])]
                yield batch.slice(i, j - i).set_column(at, text_col, pa.array(text, pa.string()))

    return run


def restored_texts(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with texts in lower case and disguised words decoded (null as empty)."""
    return docs.mapInArrow(_restored(model.of(docs, text_col).decoder, text_col), docs.schema)
