"""Periodic runs of words: where a text repeats itself at a fixed distance.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
identical) and at least ``max(least, 2 q)`` words that no neighbouring word extends. All
runs of every text are found, whatever their number, by **multi-scale minimizers**:

* **Short periods** (under ``FIRST_SCALE``): every lag is scanned directly for stretches
  of equal words.
* **Scale Q** (periods ``Q`` to ``2 Q - 1``): every block of ``Q / 2`` words is hashed and
  every window of ``Q / 2`` blocks names its least block (the leftmost of equal ones).
  The first window of a run and the one a period later both lie inside the run and hold
  the same words, so they name equal blocks exactly a period apart. Pairs of equal
  minimizers at a distance of the scale are extended word by word in both directions;
  a stretch of at least ``q`` equalities that has no shorter period is a run.
* **Blocks that repeat themselves** (inside a run of a period up to ``Q / 4``, which an
  earlier scale has found) would pair up quadratically and are left out. Runs whose
  blocks are such follow from pairs of the shorter runs: their starts or their ends are a
  period apart, or the two runs touch and every distance that keeps them in phase, up to
  the shorter one's length, is a period. Other equal blocks are over ``Q / 4`` apart, so a
  block has at most some eight partners and the work is ``n log n`` plus the runs found.

Each text is one row's work, so the job is map-only: nothing is shuffled, and a hot source
or a group of copies is spread like any other rows. A block of whole texts (a megabyte, or
one longer text) is worked on at once, with a mark between texts that equals no word.
Words are compared by 64-bit hashes.

Edge cases: null and empty texts have no words, no runs and an empty collapsed text.
Repeated rows are repeated in the result. Extra columns are ignored, whatever their names;
an id column named like an output column is refused with ValueError. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import mix, text_blocks, word_hashes, words

#: Least words of a run, whatever its period.
LEAST = 12
#: Periods under this are scanned lag by lag. Half of it must be at least ``LEAST``, so
#: that a run found before covers every block that repeats itself.
FIRST_SCALE = 32

_U = np.uint64
_STEP = 0x5851F42D4C957F2D  # odd
_OUT = ("n_words", "runs", "collapsed")
_RUN = "array<struct<start:long,length:long,period:long>>"


def _prime_factors(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] if q > 1 else out


def _primitive(w: np.ndarray, s: int, q: int) -> bool:
    """Whether the stretch of period ``q`` that begins at ``s`` has no shorter period: one
    would divide ``q``."""
    for p in _prime_factors(q):
        d = q // p
        if w[s] == w[s + d] and np.array_equal(w[s : s + q - d], w[s + d : s + q]):
            return False
    return True


def _stretches(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one of the runs of consecutive numbers in the sorted ``t``."""
    cut = np.flatnonzero(np.diff(t) != 1)
    return t[np.concatenate([[0], cut + 1])], t[np.concatenate([cut, [len(t) - 1]])] + 1


def _short_periods(w: np.ndarray, least: int, below: int) -> list[tuple[int, int, int]]:
    """Runs ``(start, end, period)`` of periods under ``below`` by direct lag scans."""
    found = []
    for q in range(1, min(below, len(w))):
        need = max(least - q, q)
        t = np.flatnonzero(w[q:] == w[:-q])
        if len(t) < need:
            continue
        s, e = _stretches(t)
        keep = np.flatnonzero(e - s >= need)
        found += [(s_, e_ + q, q) for s_, e_ in zip(s[keep].tolist(), e[keep].tolist()) if _primitive(w, s_, q)]
    return found


def _minimizers(h: np.ndarray, width: int) -> np.ndarray:
    """Positions of the least value, the leftmost of equal ones, of every window."""
    bits = max(int(len(h)).bit_length(), 1)
    # The position in the low bits breaks ties and comes out with the minimum.
    low = (h << _U(bits)) | np.arange(len(h), dtype=_U)
    have = 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    at = (low & _U((1 << bits) - 1)).astype(np.int64)
    return at[np.concatenate([[True], np.diff(at) != 0])]


def _equal_pairs(key: np.ndarray, at: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(first positions, distances)`` of the pairs of one key whose distance belongs to
    the scale. ``key`` is sorted, ``at`` within it."""
    for j in range(1, len(at)):
        far = at[j:] - at[:-j]
        near = (key[j:] == key[:-j]) & (far < 2 * scale)
        if not near.any():
            return
        hit = np.flatnonzero(near & (far >= scale))
        yield at[hit], far[hit]


def _extend(w: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """The stretch ``[lo, hi)`` around ``i`` of positions equal to those ``q`` later."""
    hi, step = i, 64
    while True:
        b = w[hi + q : hi + q + step]
        a = w[hi : hi + len(b)]
        off = np.flatnonzero(a != b)
        if len(off):
            hi += int(off[0])
            break
        hi += len(b)
        if len(b) < step:
            break
        step *= 2
    lo, step = i, 64
    while lo > 0:
        step = min(step, lo)
        off = np.flatnonzero(w[lo - step : lo] != w[lo - step + q : lo + q])
        if len(off):
            lo -= step - 1 - int(off[-1])
            break
        lo -= step
        step *= 2
    return lo, hi


def _in_phase(w: np.ndarray, s1: int, s2: int, p: int) -> int | None:
    """The distance, modulo ``p``, that maps the run of period ``p`` at ``s1`` onto the one
    at ``s2``; None where their words differ."""
    twice, other = np.concatenate([w[s1 : s1 + p]] * 2), w[s2 : s2 + p]
    for r in np.flatnonzero(twice[:p] == other[0]).tolist():
        if np.array_equal(twice[r : r + p], other):
            return (s2 - s1 - r) % p
    return None


def _touching(w: np.ndarray, p: np.ndarray, s: np.ndarray, e: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    """Runs of the scale's periods that lie across the seam of two touching shorter runs of
    one period; the arrays are sorted by period and start."""
    for k in np.flatnonzero((p[1:] == p[:-1]) & (s[1:] <= e[:-1])).tolist():
        (s1, s2), (e1, e2), unit = s[k : k + 2].tolist(), e[k : k + 2].tolist(), int(p[k])
        last = min(e1 - s1, e2 - s2, 2 * scale - 1)
        if last < scale:
            continue
        phase = _in_phase(w, s1, s2, unit)
        if phase is None:
            continue
        q = np.arange(scale + (phase - scale) % unit, last + 1, unit)
        lo, hi = np.maximum(s1, s2 - q), np.minimum(e1, e2 - q)
        ok = hi - lo >= q
        # A stretch that goes on lies across the runs' own ends: found by those.
        ok &= (lo == 0) | (w[np.maximum(lo - 1, 0)] != w[np.maximum(lo - 1, 0) + q])
        end = np.minimum(hi, len(w) - 1 - q)
        ok &= (hi + q >= len(w)) | (w[end] != w[end + q])
        yield from zip(lo[ok].tolist(), (hi + q)[ok].tolist(), q[ok].tolist())


def _scale(w: np.ndarray, value: np.ndarray, known: np.ndarray, scale: int) -> set[tuple[int, int, int]]:
    """Runs of periods ``scale`` to ``2 scale - 1``; ``known`` are those of all shorter."""
    half = scale // 2
    power = np.full(len(w), _STEP, _U)
    power[0] = 1
    inverse = np.full(len(w), pow(_STEP, -1, 1 << 64), _U)
    inverse[0] = 1
    sums = np.zeros(len(w) + 1, _U)
    np.cumsum(value * np.cumprod(power), out=sums[1:])
    h = mix((sums[half:] - sums[:-half]) * np.cumprod(inverse)[: len(w) - half + 1])
    at = _minimizers(h, half)
    inner = known[(known[:, 2] <= half // 2) & (known[:, 1] - known[:, 0] >= half)]
    if len(inner):
        by_start = inner[np.argsort(inner[:, 0], kind="stable")]
        k = np.searchsorted(by_start[:, 0], at, side="right") - 1
        at = at[(k < 0) | (at > by_start[k, 1] - half)]
    order = np.lexsort((at, h[at]))
    seeds = list(_equal_pairs(h[at[order]], at[order], scale))
    found: set[tuple[int, int, int]] = set()
    if len(inner):
        s, e, p = (x for x in inner[np.lexsort((inner[:, 0], inner[:, 2]))].T)
        seeds += _equal_pairs(p, s, scale)
        seeds += [(i - 1, q) for i, q in _equal_pairs(p, e, scale)]
        found.update(_touching(w, p, s, e, scale))
    if not seeds:
        return found
    i, q = (np.concatenate(x) for x in zip(*seeds))
    order = np.lexsort((i, q))
    before, lo, hi = 0, 0, 0
    for i_, q_ in zip(i[order].tolist(), q[order].tolist()):
        if q_ == before and lo <= i_ < hi or w[i_] != w[i_ + q_]:
            continue
        lo, hi = _extend(w, i_, q_)
        before = q_
        if hi - lo >= q_ and _primitive(w, lo, q_):
            found.add((lo, hi + q_, q_))
    return found


def find_runs(ids: np.ndarray, first: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs of a block of texts: rows ``(text, start, length, period)``, sorted.

    ``ids``: word identities; ``first``: the index of each text's first word, and their
    number at the end."""
    n = np.diff(first)
    t = np.arange(len(n))
    # A mark that equals no word after each text; no run reaches across it.
    marks = mix(t.astype(_U) + _U(0x9E3779B97F4A7C15)).view(np.int64)
    w = np.empty(len(ids) + len(n), np.int64)
    w[first[1:] + t] = marks
    w[np.arange(len(ids)) + np.repeat(t, n)] = ids
    begin = first[:-1] + t
    base = max(FIRST_SCALE, 2 * least)
    runs = [np.array(_short_periods(w, least, base), np.int64).reshape(-1, 3)]
    scale = base
    while len(n) and n.max() >= 2 * scale:
        # Only texts long enough for the scale, put side by side.
        long = np.flatnonzero(n >= 2 * scale)
        size = n[long] + 1
        offset = np.concatenate([[0], np.cumsum(size)])
        shift = np.repeat(begin[long] - offset[:-1], size)
        some = w[np.arange(offset[-1]) + shift]
        known = np.concatenate(runs)
        owner = np.searchsorted(begin, known[:, 0], side="right") - 1
        place = np.searchsorted(long, owner)
        inside = (place < len(long)) & (long[np.minimum(place, len(long) - 1)] == owner)
        move = (begin[long] - offset[:-1])[place[inside]]
        known = known[inside] - np.stack([move, move, np.zeros_like(move)], axis=1)
        found = _scale(some, mix(some.view(_U)), known, scale)
        if found:
            new = np.array(sorted(found), np.int64)
            back = shift[new[:, 0]]
            runs.append(new + np.stack([back, back, np.zeros_like(back)], axis=1))
        scale *= 2
    s, e, q = np.concatenate(runs).T
    owner = np.searchsorted(begin, s, side="right") - 1
    out = np.stack([owner, s - begin[owner] if len(s) else s, e - s, q], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _kept_words(first: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Words that no run holds after its first period."""
    change = np.zeros(first[-1] + 1, np.int64)
    begin = first[runs[:, 0]] + runs[:, 1]
    np.add.at(change, begin + runs[:, 3], 1)
    np.add.at(change, begin + runs[:, 2], -1)
    return np.cumsum(change[:-1]) == 0


def _joined(data: np.ndarray, s: np.ndarray, e: np.ndarray, text: np.ndarray, n_texts: int) -> pa.Array:
    """The words joined by one space, one string per text."""
    last = np.concatenate([text[1:] != text[:-1], [True]]) if len(text) else np.zeros(0, bool)
    size = e - s + ~last
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    out = np.full(total, 0x20, np.uint8)
    length = e - s
    src = np.arange(int(length.sum())) + np.repeat(s - np.cumsum(length) + length, length)
    dst = np.arange(len(src)) + np.repeat(end - size - np.cumsum(length) + length, length)
    out[dst] = data[src]
    offsets = np.zeros(n_texts + 1, np.int64)
    np.add.at(offsets, text + 1, size)
    offsets = np.cumsum(offsets)
    return pa.LargeStringArray.from_buffers(n_texts, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out.tobytes()))


def _run(ids: list[str], text_col: str, least: int):
    def block(kept: list[pa.Array], off: np.ndarray, data: np.ndarray) -> pa.RecordBatch:
        s, e, first = words(off, data)
        runs = find_runs(word_hashes(data, s, e).view(np.int64), first, least)
        keep = _kept_words(first, runs)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        collapsed = _joined(data, s[keep], e[keep], text[keep], len(first) - 1)
        spans = pa.StructArray.from_arrays(
            [pa.array(runs[:, k]) for k in (1, 2, 3)], names=["start", "length", "period"]
        )
        at = np.searchsorted(runs[:, 0], np.arange(len(first)))
        lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), spans)
        cols = [*kept, pa.array(np.diff(first)), lists, collapsed.cast(pa.string())]
        return pa.RecordBatch.from_arrays(cols, names=[*ids, *_OUT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, off, data in text_blocks(batch, text_col):
                part = batch.slice(i, j - i)
                yield block([part.column(part.schema.get_field_index(c)) for c in ids], off, data)

    return run


def periodic_runs(docs: DataFrame, ids: tuple[str, ...] = ("doc_id",), text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row per row of ``docs``: its ``ids``, ``n_words``, ``runs`` (start, length and
    period in words, sorted by start, then period) and ``collapsed``, the text without the
    words that a run holds after its first period, joined by one space."""
    clash = set(ids) & set(_OUT)
    if clash or text_col in ids:
        raise ValueError(f"id columns named like other columns of the result: {sorted(clash or {text_col})}")
    if least < 2:
        raise ValueError("a run has at least two words")
    rows = docs.select(*ids, text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in ids)
    out = f"n_words long, runs {_RUN}, collapsed string"
    return rows.mapInArrow(_run(list(ids), text_col, least), f"{schema}, {out}")
