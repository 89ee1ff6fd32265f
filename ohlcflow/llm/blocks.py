"""Arrow text columns as byte blocks for vectorised numpy work inside tasks.

A block holds whole texts of a few megabytes (one very long text may exceed
it), so a task's memory does not follow the size of a record batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Target bytes of a block.
BLOCK_BYTES = 1 << 20

# ASCII white space: space and U+0009 to U+000D.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: ASCII lower-casing of bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64


def lower_case(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin-1 letters; other letters stay as they are."""
    out = LOWER[data]
    # Second byte 0x80-0x9E after 0xC3 is a capital (0x97 is the times sign).
    second = (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)
    out[1:][second] += 0x20
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply): every input bit reaches
    every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_blocks(
    batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, offsets, bytes)`` of runs of whole texts.

    Null texts are empty. ``offsets`` are relative to ``bytes``.
    """
    arr = batch.column(batch.schema.get_field_index(column))
    if arr.null_count:
        arr = arr.fill_null("")
    if len(arr) == 0:
        return
    wide = pa.types.is_large_string(arr.type)
    _, off_buf, data_buf = arr.buffers()
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(off_buf, dtype=kind, count=arr.offset + len(arr) + 1)[arr.offset :].astype(np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    i, n = 0, len(arr)
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, off[i : j + 1] - off[i], data[off[i] : off[j]]
        i = j


def words(offsets: np.ndarray, data: np.ndarray, is_word: np.ndarray | None = None):
    """Start and end byte of every word, and the index of the first word of
    each text (one more entry than texts). Words never cross texts."""
    w = ~_SPACE[data] if is_word is None else is_word[data]
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    start = w.copy()
    start[1:] &= ~w[:-1]
    first = offsets[:-1][offsets[:-1] < n]
    start[first] |= w[first]
    end = w.copy()
    end[:-1] &= ~w[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    end[last] |= w[last]
    s = np.flatnonzero(start)
    e = np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offsets)


def separated(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a block with a space put after each, so that no pattern spans two."""
    n = len(offsets) - 1
    out = np.full(len(data) + n, 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
    return offsets + np.arange(n + 1), out


# Fixed pseudo-random value of each byte for the word hash.
_TABLE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2B  # odd: invertible modulo 2**64
_POW: np.ndarray = np.ones(1, _U)
_INV: np.ndarray = np.ones(1, _U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, BLOCK_BYTES + (1 << 16))
        b = np.full(size, _BASE, dtype=_U)
        b[0] = 1
        _POW = np.cumprod(b)
        b[1:] = pow(_BASE, -1, 1 << 64)
        _INV = np.cumprod(b)
    return _POW, _INV


def prefix_sums(data: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """What ``span_hashes`` needs of a block. ``fold`` maps bytes first (for instance
    ASCII lower case)."""
    pw, _ = _powers(len(data) + 1)
    table = _TABLE if fold is None else _TABLE[fold]
    c = np.zeros(len(data) + 1, _U)
    np.cumsum(table[data] * pw[: len(data)], out=c[1:])
    return c


def span_hashes(c: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial over per-byte random values,
    then ``mix``."""
    _, inv = _powers(len(c))
    return mix((c[e] - c[s]) * inv[s] + (e - s).astype(_U))


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    return span_hashes(prefix_sums(data, fold), s, e)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as the LONG that Spark stores."""
    return x.view(np.int64)
