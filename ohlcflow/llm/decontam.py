"""Benchmark decontamination by latent semantic retrieval.

**Space.** Words (lower case, letters and digits) fall into hashed dimensions. All
documents are cut into passages of ``PASSAGE`` words; ``A`` is their TF-IDF matrix, rows
of length one. A randomised SVD finds its leading right singular vectors: each task sums
``A' (A W)`` over its passages for one fixed random ``W``, Spark adds the sums up, and the
Nystrom form of that one sketch gives the basis and the singular values. What reaches the
driver is one matrix of dimensions by rank, whatever the corpus.

**Candidates.** Items and document windows are mapped into the space and whitened (each
direction divided by its singular value), so that common directions, the language above
all, do not make everything alike. Windows have about the item's length and advance by a
third of it; every window is compared with every item of its length class, a block of
items at a time, by cosine. A paraphrase may fall below any useful cosine, so whatever
could pass the check is a candidate as well: no subsequence is longer than the words in
common, so a stretch of text that the check accepts holds at least as many of the item's
words as the check asks for. Such stretches are found by counting the item's words, without
a stride; the words that most items share may be left out of the count, and then count
as found.

**Check.** A candidate's surroundings are aligned with the item: the longest common
subsequence of words, as a share of the item, and the share of the item's answer (its last
sentence, or its last quarter) found there in order. Near verbatim copies pass by the first
alone, paraphrases need both.

Edge cases: null and empty texts, and items without words, match nothing. Items of equal
text each match. Items shorter than ``SHORTEST`` words cannot be told from chance and must
occur whole. Texts are read whole, in windows, however long. Repeated rows match alike;
extra columns pass through. An empty corpus or benchmark gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import lower_case, signed, text_blocks, word_hashes, words
from .common import own_names

#: Hashed dimensions, words of a passage, rank of the space, oversampling.
DIMENSIONS, PASSAGE, RANK, MORE = 4096, 64, 48, 8
#: Least cosine of a candidate.
COSINE = 0.5
#: Share of the item in the common subsequence: alone, or with the answer's share.
VERBATIM, PARAPHRASE, ANSWER = 0.75, 0.5, 0.75
#: Items with fewer words must occur whole.
SHORTEST = 8
#: Words of more than this share of the items may be left out when words in common are
#: counted, as long as this share of an item must be found among its other words.
COMMON, COUNTED = 0.05, 0.2
#: Steps by which stretches advance within the surroundings of an item; counts (stretches
#: by items) held at a time.
STEPS = 2
COUNT_CELLS = 4_000_000
#: Words of stretches that are looked at in detail at a time.
WINDOW_WORDS = 1 << 18
#: Cells (items by words) up to which the words of items are looked up in a table.
SLOT_CELLS = 4_000_000
#: Ratio between window lengths of neighbouring classes; items compared at a time.
LENGTH_STEP, ITEM_BLOCK = 1.5, 4096
#: Bytes of text that a task maps at a time.
MAP_BYTES = 1 << 18

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[0x30:0x3A] = True
_WORD_BYTE[0x41:0x5B] = True
_WORD_BYTE[0x61:0x7B] = True
_WORD_BYTE[0x80:] = True
_U = np.uint64


def _hashed_words(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block, and the first word of each text."""
    s, e, first = words(off, data, _WORD_BYTE)
    return word_hashes(lower_case(data), s, e), first


def _dims(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> _U(24)) % _U(n)).astype(np.int64)


def _passages(first: np.ndarray, size: int) -> np.ndarray:
    """Passage of each word: runs of ``size`` words that do not cross texts."""
    length = np.diff(first)
    at = np.arange(first[-1]) - np.repeat(first[:-1], length)
    base = np.concatenate(([0], np.cumsum(-(-length // size))))[:-1]
    return np.repeat(base, length) + at // size


def _cells(off: np.ndarray, data: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passage, dimension and count of the filled cells of a block's term matrix, in
    passage order."""
    h, first = _hashed_words(off, data)
    p = _passages(first, PASSAGE)
    kind = np.int32 if len(h) and (p[-1] + 1) * dims < 1 << 31 else np.int64
    cell, tf = np.unique((p * dims + _dims(h, dims)).astype(kind), return_counts=True)
    return cell // dims, cell % dims, tf


def _count_passages(dims: int):
    """Passages that have each dimension, summed over a task; dimension -1 counts them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total = np.zeros(dims, np.int64), 0
        for batch in batches:
            for _, _, off, data in text_blocks(batch, "text", MAP_BYTES):
                p, d, _ = _cells(off, data, dims)
                if len(p):
                    total += int(p[-1]) + 1
                    df += np.bincount(d, minlength=dims)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(df[at], total))], names=["dim", "n"]
        )

    return run


def _random_matrix(dims: int, width: int) -> np.ndarray:
    return np.random.default_rng(20240229).standard_normal((dims, width)).astype(np.float32)


def _sketch(idf: np.ndarray, dims: int, width: int):
    """A task's sum of ``A' (A W)``, a row per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A row per direction, so that sums go along contiguous memory.
        w = np.ascontiguousarray(_random_matrix(dims, width).T)
        out = np.zeros((width, dims))
        for batch in batches:
            for _, _, off, data in text_blocks(batch, "text", MAP_BYTES):
                p, d, tf = _cells(off, data, dims)
                if not len(p):
                    continue
                a = (tf * idf[d]).astype(np.float32)
                starts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
                norm = np.sqrt(np.add.reduceat(a * a, starts))
                a /= np.where(norm > 0, norm, 1)[p]
                y = np.add.reduceat(np.take(w, d, axis=1) * a, starts, axis=1)
                back = np.take(y, p, axis=1) * a
                for k in range(width):
                    out[k] += np.bincount(d, weights=back[k], minlength=dims)
        at = np.flatnonzero(out.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), *[pa.array(out[k, at]) for k in range(width)]],
            names=["dim", *[f"v{k}" for k in range(width)]],
        )

    return run


class LatentSpace:
    """Whitened projection of hashed words: ``weights[dim]`` is a word's contribution."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.astype(np.float32)


def latent_space(
    docs: DataFrame, text_col: str = "text", dims: int = DIMENSIONS, rank: int = RANK, more: int = MORE
) -> LatentSpace:
    """Basis and singular values of all passages of ``docs``, by randomised SVD."""
    text = docs.select(F.col(text_col).alias("text")).where("text is not null")
    sums = (
        text.mapInArrow(_count_passages(dims), "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).toArrow()
    )
    dim, n = sums.column("dim").to_numpy(), sums.column("n").to_numpy()
    total = int(n[dim == -1].sum()) if len(dim) else 0
    idf = np.zeros(dims, np.float32)
    real = dim >= 0
    idf[dim[real]] = np.log((total + 1) / (n[real] + 0.5))
    if not total:
        return LatentSpace(np.zeros((dims, rank)))
    # Dimensions never seen, as in items, weigh like the rarest.
    idf[idf == 0] = np.log((total + 1) / 0.5)
    width = rank + more
    schema = "dim long, " + ", ".join(f"v{k} double" for k in range(width))
    z_rows = (
        text.mapInArrow(_sketch(idf, dims, width), schema)
        .groupBy("dim")
        .agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(width)])
        .toArrow()
    )
    z = np.zeros((dims, width))
    z[z_rows.column("dim").to_numpy()] = np.column_stack([z_rows.column(f"v{k}").to_numpy() for k in range(width)])
    # Nystrom: C = A'A is about Z (W'Z)^-1 Z'; a small shift keeps the root real.
    w = _random_matrix(dims, width).astype(float)
    shift = 1e-7 * np.linalg.norm(z) / max(np.linalg.norm(w), 1)
    z += shift * w
    core = w.T @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > values.max() * 1e-10
    root = z @ (vectors[:, keep] / np.sqrt(values[keep]))
    basis, sing, _ = np.linalg.svd(root, full_matrices=False)
    basis, sing = basis[:, :rank], np.maximum(sing[:rank], 1e-9)
    return LatentSpace(idf[:, None] * basis / sing * sing[0])


def _lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel in ``a``."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        m = at.get(x, 0)
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _reach(size: int, n: int) -> int:
    """Words on either side of a window that belong to its surroundings."""
    return max(size, n) // 2 + 1


def _least(n: int) -> int:
    """Words that an item of ``n`` words must have in common with a text to be found."""
    return int(np.ceil(PARAPHRASE * n)) if n >= SHORTEST else n


class _Overlap:
    """Items of a length class by their words, to count words in common with texts.

    ``first[v]`` to ``first[v + 1]`` are the entries of ``item`` that have word ``v`` of
    the vocabulary, ``times`` each. Surroundings that hold an item, ``spans`` words, have
    ``need`` of the words of that item at least."""

    def __init__(self, part: np.ndarray, size: int, words: list[list[int]], vocab: np.ndarray, df: np.ndarray, n_items: int):
        self.part, self.size = part, size
        self.spans = np.array([max(size, len(words[i])) + 2 * _reach(size, len(words[i])) for i in part])
        self.step = -(-int(self.spans.max()) // STEPS)
        self.need = np.zeros(len(part), np.int64)
        ids, owners, counts = [], [], []
        for m, i in enumerate(part):
            v, tf = np.unique(np.searchsorted(vocab, np.array(words[i], np.int64)), return_counts=True)
            n = len(words[i])
            spare = _least(n) - max(min(2, _least(n)), int(np.ceil(COUNTED * n)))
            order = np.argsort(-df[v], kind="stable")
            order = order[df[v[order]] > max(COMMON * n_items, 1)]
            order = order[np.cumsum(tf[order]) <= spare]
            self.need[m] = _least(n) - tf[order].sum()
            ids.append(np.delete(v, order))
            owners.append(np.full(len(ids[-1]), m))
            counts.append(np.delete(tf, order))
        ids, owners, counts = np.concatenate(ids), np.concatenate(owners), np.concatenate(counts)
        order = np.argsort(ids, kind="stable")
        self.item, self.times = owners[order], counts[order]
        self.first = np.searchsorted(ids[order], np.arange(len(vocab) + 1))

    def stretches(self, pos: np.ndarray, word: np.ndarray, before: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """``(start, item)`` of the stretches whose words are enough; surroundings that
        begin in the first ``step`` words of a stretch lie in it. ``word[j]`` of the
        vocabulary stands at ``pos[j]`` of ``n`` words, and at ``before[j]`` last."""
        rows, size = n // self.step + 1, max(COUNT_CELLS // len(self.part), 1)
        found = []
        for low in range(0, rows, size):
            some = min(size, rows - low)
            count = np.zeros(some * len(self.part), np.int64)
            for back in range(STEPS + 1):
                # A word counts once in a stretch, with all its places in the item.
                i, j = np.searchsorted(pos, [(low + back) * self.step, (low + back + some) * self.step])
                row = pos[i:j] // self.step - back
                new = np.flatnonzero(before[i:j] < row * self.step)
                v, row = word[i:j][new], row[new]
                times = self.first[v + 1] - self.first[v]
                at = np.repeat(self.first[v] - np.cumsum(times) + times, times) + np.arange(times.sum())
                cell = np.repeat((row - low) * len(self.part), times) + self.item[at]
                # Sums of small integers are exact.
                count += np.bincount(cell, self.times[at], len(count)).astype(np.int64)
            k, m = np.nonzero(count.reshape(some, -1) >= self.need)
            found.append(((k + low) * self.step, m))
        return np.concatenate([k for k, _ in found]), np.concatenate([m for _, m in found])


class _Items:
    """Benchmark items by length class: ids, word hashes, latent vectors, answers."""

    def __init__(self, ids: list, texts: list[str], space: LatentSpace):
        self.ids, self.space = ids, space
        self.words: list[list[int]] = []
        self.answers: list[list[int]] = []
        self.times: list[dict[int, int]] = []
        vectors, lengths = [], []
        for text in texts:
            h = self._hash(text)
            self.words.append(signed(h).tolist())
            self.times.append(dict(Counter(self.words[-1])))
            self.answers.append(self._answer(text, h))
            x = space.weights[_dims(h, len(space.weights))].sum(axis=0) if len(h) else np.zeros(space.weights.shape[1])
            vectors.append(x / max(np.linalg.norm(x), 1e-12))
            lengths.append(len(h))
        self.vectors = np.array(vectors, np.float32).reshape(len(ids), space.weights.shape[1])
        # The nearest class below or at the length; the shortest items share one.
        self.classes: dict[int, np.ndarray] = {}
        for i, n in enumerate(lengths):
            if n:
                step = max(int(np.floor(np.log(max(n, SHORTEST) / SHORTEST) / np.log(LENGTH_STEP) + 1e-9)), 0)
                size = int(round(SHORTEST * LENGTH_STEP ** (step + 0.5))) if n >= SHORTEST else max(n, 1)
                self.classes.setdefault(size, []).append(i)
        self.classes = {k: np.array(v) for k, v in self.classes.items()}
        self.vocab = np.unique(np.array([x for w in self.words for x in w], np.int64))
        df = np.bincount(np.searchsorted(self.vocab, [x for t in self.times for x in t]), minlength=len(self.vocab))
        # Each item's words by their number in the vocabulary, one item after the other, and how
        # often it has them.
        kinds = [np.unique(np.searchsorted(self.vocab, np.array(x, np.int64)), return_counts=True) for x in self.words]
        many = [len(v) for v, _ in kinds]
        self.kind_times = np.concatenate([tf for _, tf in kinds]) if kinds else np.zeros(0, np.int64)
        self.kind_keys = np.repeat(np.arange(len(ids)), many) * len(self.vocab)
        if kinds:
            self.kind_keys += np.concatenate([v for v, _ in kinds])
        # The same as a table, where it is small.
        self.slots = None
        if len(ids) * len(self.vocab) <= SLOT_CELLS:
            self.slots = np.full(len(ids) * len(self.vocab), -1, np.int32)
            self.slots[self.kind_keys] = np.arange(len(self.kind_keys))
        self.lengths = np.array(lengths, np.int64)
        self.least = np.array([_least(n) for n in lengths], np.int64)
        self.overlaps = [
            _Overlap(v[b : b + ITEM_BLOCK], k, self.words, self.vocab, df, len(ids))
            for k, v in self.classes.items()
            for b in range(0, len(v), ITEM_BLOCK)
        ]

    def places(self, item: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Where in ``kind_keys`` each word of the vocabulary is as its item's; -1 for none."""
        key = item * len(self.vocab) + word
        if self.slots is not None:
            return self.slots[key]
        at = np.minimum(self.kind_keys.searchsorted(key), len(self.kind_keys) - 1)
        return np.where(self.kind_keys[at] == key, at, -1)

    @staticmethod
    def _hash(text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), np.uint8)
        return _hashed_words(np.array([0, len(raw)]), raw)[0]

    def _answer(self, text: str, h: np.ndarray) -> list[int]:
        """The last sentence, if it is a part of the item; else the last quarter."""
        body = text.strip().rstrip(".!?")
        cut = max(body.rfind(c) for c in ".!?\n")
        tail = self._hash(body[cut + 1 :]) if cut >= 0 else h
        if not 2 <= len(tail) <= len(h) // 2:
            tail = h[len(h) - max(len(h) // 4, 1) :]
        return signed(np.ascontiguousarray(tail)).tolist()


def _windows(
    items: _Items, group: _Overlap, begin: np.ndarray, which: np.ndarray, pos: np.ndarray, word: np.ndarray, first: np.ndarray
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """``(text, item, start, words, item's words, words in common)`` of the surroundings in
    ``stretches`` that have enough of an item's words; of a stretch, those with most come first.
    Stretches with ``WINDOW_WORDS`` words, or one longer one, are looked at together."""
    i, j = pos.searchsorted(begin), pos.searchsorted(begin + (STEPS + 1) * group.step)
    ends = np.cumsum(j - i)
    low = 0
    while low < len(i):
        high = max(int(ends.searchsorted(ends[low] - (j - i)[low] + WINDOW_WORDS, side="right")), low + 1)
        part = slice(low, high)
        yield from _windows_of(items, group, begin[part], group.part[which[part]], i[part], j[part], pos, word, first)
        low = high


def _windows_of(
    items: _Items, group: _Overlap, begin: np.ndarray, item: np.ndarray, i: np.ndarray, j: np.ndarray, pos: np.ndarray,
    word: np.ndarray, first: np.ndarray
) -> Iterator[tuple[int, int, int, int, int, int]]:
    least, n_words = items.least[item], items.lengths[item]
    span = group.spans[group.part.searchsorted(item)]
    # The words of each stretch that are the item's, by stretch and place.
    size = j - i
    of = np.repeat(np.arange(len(i)), size)
    at = np.arange(len(of)) + np.repeat(i - np.cumsum(size) + size, size)
    kind = items.places(item[of], word[at])
    hit = np.flatnonzero(kind >= 0)
    of, at, kind = of[hit], pos[at[hit]], kind[hit]
    # Which occurrence of its word in the stretch each is, and how often the item has it.
    times = items.kind_times[kind]
    cell = of * len(items.kind_times) + kind
    by_word = np.argsort(cell, kind="stable")
    cell = cell[by_word]
    new = np.ones(len(cell), bool)
    new[1:] = cell[1:] != cell[:-1]
    run = np.flatnonzero(new)
    nth = np.arange(len(cell)) - np.repeat(run, np.diff(np.append(run, len(cell))))
    taken = nth < times[by_word]
    # No more than this many places of the item can be found.
    some = np.bincount(of[by_word][taken], minlength=len(i)) >= least
    if not some.any():
        return
    # Where a word's places in the item are taken: as many occurrences before.
    full = np.full(len(of), -1)
    over = np.flatnonzero(~taken)
    full[by_word[over]] = by_word[over - times[by_word[over]]]
    # Surroundings begin at a word of the item and end with the text.
    text = np.searchsorted(first, at, side="right") - 1
    far = int(first[-1]) + 1
    end = np.searchsorted(of * far + at, of * far + np.minimum(at + span[of], first[text + 1]))
    count = end - np.arange(len(of))
    # A word does not count in surroundings that begin no later than the occurrence that takes its
    # place and end after it: ends never fall, so these follow one another.
    more = np.flatnonzero(full >= 0)
    less = np.zeros(len(of) + 1, np.int64)
    from_, to = np.searchsorted(end, more, side="right"), full[more] + 1
    inside = from_ < to
    np.add.at(less, from_[inside], 1)
    np.subtract.at(less, to[inside], 1)
    count -= np.cumsum(less[:-1])
    # Those that begin after the first step are in the next stretch.
    enough = np.flatnonzero((at < begin[of] + group.step) & (count >= least[of]) & some[of])
    enough = enough[np.lexsort((-count[enough], of[enough]))]
    c = of[enough]
    yield from zip(*(x.tolist() for x in (text[enough], item[c], at[enough], span[c], n_words[c], count[enough])))


def _find(items: _Items, keep: list[str], text_col: str):
    """Rows of (kept columns, item, cosine, lcs, answer) of the items a text contains."""

    def check(w: np.ndarray, item: int, at: int, size: int) -> tuple[float, float] | None:
        want = items.words[item]
        reach = _reach(size, len(want))
        near = w[max(at - reach, 0) : at + max(size, len(want)) + reach].tolist()
        times = items.times[item]
        # No subsequence is longer than the words in common.
        if sum([times[x] for x in times.keys() & set(near)]) < PARAPHRASE * len(want):
            return None
        if len(want) < SHORTEST:
            whole = any(near[k : k + len(want)] == want for k in range(len(near) - len(want) + 1))
            return (1.0, 1.0) if whole else None
        near = [x for x in near if x in times]
        share = _lcs(want, near) / len(want)
        told = _lcs(items.answers[item], near) / len(items.answers[item])
        if share >= VERBATIM or share >= PARAPHRASE and told >= ANSWER:
            return share, told
        return None

    def shared_words(
        w: np.ndarray, first: np.ndarray, maybe: set[tuple[int, int]]
    ) -> Iterator[tuple[int, int, float, float, float]]:
        """``(text, item, cosine, lcs, answer)`` of what is found by words in common; all pairs
        that have enough of them go to ``maybe``."""
        if not len(items.vocab):
            return
        weights = items.space.weights
        word = np.minimum(np.searchsorted(items.vocab, w), len(items.vocab) - 1)
        pos = np.flatnonzero(items.vocab[word] == w)
        word = word[pos]
        order = np.argsort(word, kind="stable")
        before = np.full(len(pos), -1)
        again = np.flatnonzero(np.diff(word[order]) == 0)
        before[order[again + 1]] = pos[order[again]]
        best: dict[tuple[int, int], tuple[int, int, float, float]] = {}
        for group in items.overlaps:
            begin, which = group.stretches(pos, word, before, len(w))
            for t, it, at, span, n, count in _windows(items, group, begin, which, pos, word, first):
                maybe.add((t, it))
                old = best.get((t, it))
                if old is not None and count <= old[2] * n:
                    continue
                a, b = int(first[t]), int(first[t + 1])
                got = check(w[a:b], it, at - a + _reach(group.size, n), group.size)
                if got and (old is None or got[0] > old[2]):
                    best[t, it] = (at, span, *got)
        for (t, it), (at, span, share, told) in best.items():
            # The best window of the item's length there.
            x = weights[_dims(w[at : min(at + span, first[t + 1])].view(_U), len(weights))]
            x = np.concatenate((np.zeros((1, x.shape[1])), np.cumsum(x, axis=0, dtype=float)))
            n = min(len(items.words[it]), len(x) - 1)
            x = x[n:] - x[: len(x) - n]
            like = x @ items.vectors[it] / np.maximum(np.linalg.norm(x, axis=1), 1e-12)
            yield t, it, float(like.max()), share, told

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = items.space.weights
        by_direction = np.ascontiguousarray(weights.T)
        for batch in batches:
            row, item, cosine, lcs, answer = [], [], [], [], []
            for i, _, off, data in text_blocks(batch, text_col, MAP_BYTES):
                h, first = _hashed_words(off, data)
                if not len(h):
                    continue
                w = signed(h)
                maybe: set[tuple[int, int]] = set()
                best: dict[tuple[int, int], tuple] = {(t, it): x for t, it, *x in shared_words(w, first, maybe)}
                if not maybe:
                    continue
                # Only texts with a pair that can pass are mapped.
                some = np.array(sorted({t for t, _ in maybe}))
                length = np.zeros(len(first) - 1, np.int64)
                length[some] = np.diff(first)[some]
                start = np.concatenate(([0], np.cumsum(length)))
                mapped = np.arange(start[-1]) + np.repeat(first[:-1] - start[:-1], length)
                # A row per direction: running sums go along contiguous memory.
                sums = np.zeros((weights.shape[1], len(mapped) + 1), np.float32)
                np.cumsum(np.take(by_direction, _dims(h[mapped], len(weights)), axis=1), axis=1, out=sums[:, 1:])
                for size, members in items.classes.items():
                    stride = max(size // 3, 1)
                    # Windows of each text, the last one flush with its end.
                    n_win = np.where(length > 0, 1 + np.maximum(-(-(length - size) // stride), 0), 0)
                    text = np.repeat(np.arange(len(length)), n_win)
                    k = np.arange(len(text)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
                    lo = start[text] + np.minimum(k * stride, np.maximum(length[text] - size, 0))
                    hi = np.minimum(lo + size, start[text + 1])
                    x = np.take(sums, hi, axis=1) - np.take(sums, lo, axis=1)
                    least = COSINE * np.maximum(np.sqrt(np.einsum("ij,ij->j", x, x)), 1e-12)
                    for b in range(0, len(members), ITEM_BLOCK):
                        part = members[b : b + ITEM_BLOCK]
                        like = items.vectors[part] @ x
                        for m, q in zip(*np.nonzero(like >= least)):
                            t, it = int(text[q]), int(part[m])
                            # Fewer words in common than any subsequence that passes has.
                            if (t, it) not in maybe:
                                continue
                            c = float(like[m, q] / least[q] * COSINE)
                            old = best.get((t, it))
                            if old is not None and old[1] >= 1.0:
                                continue
                            got = check(w[first[t] : first[t + 1]], it, int(lo[q] - start[t]), size)
                            if got and (old is None or got[0] > old[1]):
                                best[t, it] = (c, *got)
                for (t, it), (c, share, told) in sorted(best.items()):
                    row.append(i + t)
                    item.append(items.ids[it])
                    cosine.append(c)
                    lcs.append(share)
                    answer.append(told)
            at = pa.array(row, pa.int64())
            kept = [batch.column(batch.schema.get_field_index(c)).take(at) for c in keep]
            found = [pa.array(item, pa.int64()), *[pa.array(v, pa.float64()) for v in (cosine, lcs, answer)]]
            yield pa.RecordBatch.from_arrays(
                [*kept, *found], names=[*keep, "item_id", "cosine", "lcs_share", "answer_share"]
            )

    return run


def _items(benchmark: DataFrame, space: LatentSpace, item_id: str, item_text: str, max_items: int) -> _Items:
    rows = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    got = rows.where("id is not null and text is not null").orderBy("id", "text").limit(max_items + 1).collect()
    if len(got) > max_items:
        raise ValueError(f"more than {max_items} items; pass the benchmark in parts")
    return _Items([r["id"] for r in got], [r["text"] for r in got], space)


@own_names("item_id", "cosine", "lcs_share", "answer_share")
def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    space: LatentSpace | None = None,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_items: int = 100_000,
) -> DataFrame:
    """``docs`` without the text, a row per item found in it: ``item_id``, ``cosine``,
    ``lcs_share``, ``answer_share``.

    The benchmark is the stated query set: it goes to every task, in blocks of
    ``ITEM_BLOCK`` items, and may have ``max_items`` items; call again for more."""
    items = _items(benchmark, space or latent_space(docs, text_col), item_id, item_text, max_items)
    keep = [c for c in docs.columns if c != text_col]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name in keep)
    return docs.mapInArrow(
        _find(items, keep, text_col), schema + "item_id long, cosine double, lcs_share double, answer_share double"
    )


def _clean(items: _Items, columns: list[str], text_col: str):
    find = _find(items, ["_row"], text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbered = pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(text_col)), pa.array(np.arange(batch.num_rows))],
                names=[text_col, "_row"],
            )
            found = {r for b in find(iter([numbered])) for r in b.column(0).to_pylist()}
            yield batch.filter(pa.array([r not in found for r in range(batch.num_rows)], pa.bool_()))

    return run


def clean_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    space: LatentSpace | None = None,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    max_items: int = 100_000,
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, columns unchanged."""
    items = _items(benchmark, space or latent_space(docs, text_col), item_id, item_text, max_items)
    return docs.mapInArrow(_clean(items, docs.columns, text_col), docs.schema)
