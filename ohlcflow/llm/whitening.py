"""Whitening of embeddings from exact integer second moments.

Entries become integers, ``x = floor(1024 c) + 100000``. **Bit-sliced scatter**: in blocks
of rows each dimension's values, shifted by the block's minimum, are split into bit
planes, and 64 rows of a plane are packed into a word. The sum of ``x_i x_j`` over the
rows is then the sum, over pairs of planes, of the bits set in both (AND and popcount)
weighted by the planes' powers of two; the shifts are put back as integers. Spark adds up
the blocks' sums, so the sums over all rows are exact whatever the order. The centred
scatter ``n C - S S^T`` is an integer matrix too; only then it becomes a covariance in
doubles and goes to ``eigh``.

What leaves a task is one row per pair of dimensions; what reaches the driver is a matrix
of dimensions by dimensions. Rows are never shuffled: the table is scanned for the
dimension, for the scatter, for the covariance of the whitened rows, and for the result.

Edge cases: rows whose vector is null, empty, of another than the commonest length, or
holds null or non-finite entries are dropped. ``x`` beyond a long's range stays at its
end. Repeated rows count as often as they occur; a null id is kept. A component without
variance (its eigenvalue is within rounding of zero: constant dimensions, fewer rows than
dimensions, a single row) has ``whitened`` null and ``explained`` 0, and the identity
error speaks of the others. An empty table, or one without usable vectors, gives an empty
result. Extra columns are ignored; id columns named like result columns are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import matrix_blocks, usable_vectors

SCALE, SHIFT = 1024, 100_000
#: An eigenvalue at or under this share of the greatest is rounding, not variance.
NO_VARIANCE = 1e-10
#: Sums travel as four limbs of this many bits, the last one signed, so that Spark's long
#: sums stay exact over a million tasks.
LIMB = 40
#: Words of one AND at a time.
WORDS_AT_ONCE = 1 << 20

_OUT = ("component", "n", "deviation", "whitened", "explained", "identity_error")
_SUMS = "i int, j int, l0 long, l1 long, l2 long, l3 long, lo long, hi long"


def integers(c: np.ndarray) -> np.ndarray:
    """``floor(1024 c) + 100000`` as longs; beyond their range, its end."""
    with np.errstate(over="ignore"):
        f = np.floor(c * float(SCALE))
    top = 2.0**63
    inside = np.where(np.abs(f) < top, f, 0.0).astype(np.int64)
    ends = np.where(f >= top, np.iinfo(np.int64).max, np.where(f <= -top, np.iinfo(np.int64).min, inside))
    return np.minimum(ends, np.iinfo(np.int64).max - SHIFT) + SHIFT


def _planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of the unsigned ``y[row, dim]``: words ``[bit, dim, 64 rows]``."""
    rows, d = y.shape
    packed = np.zeros((bits, d, -(-rows // 64) * 8), np.uint8)
    for b in range(bits):
        some = np.packbits(((y >> np.uint64(b)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        packed[b, :, : some.shape[1]] = some
    return packed.view(np.uint64)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact ``(sums, cross products)`` of the integer rows ``x``, as Python integers."""
    rows, d = x.shape
    low = x.min(axis=0)
    y = x.view(np.uint64) - low.view(np.uint64)
    bits = max(int(y.max()).bit_length(), 1)
    planes = _planes(y, bits)
    width = planes.shape[2]
    ones = np.bitwise_count(planes).sum(axis=2, dtype=np.int64).astype(object)
    # Cross products in longs where they fit, else as Python integers.
    fits = 2 * bits + rows.bit_length() < 62
    cross = np.zeros((d, d), np.int64 if fits else object)
    step = max(1, WORDS_AT_ONCE // (d * width))
    for a in range(bits):
        for b in range(a, bits):
            both = np.empty((d, d), np.int64)
            for i in range(0, d, step):
                shared = planes[a, i : i + step, None, :] & planes[b, None, :, :]
                both[i : i + step] = np.bitwise_count(shared).sum(axis=2, dtype=np.int64)
            pair = both if a == b else both + both.T
            cross += (pair << (a + b)) if fits else pair.astype(object) * (1 << (a + b))
    sums = sum(ones[b] * (1 << b) for b in range(bits))
    low, cross = low.astype(object), cross.astype(object)
    moved = np.outer(low, sums)
    return sums + rows * low, cross + moved + moved.T + rows * np.outer(low, low)


def _limbs(value: int) -> list[int]:
    mask = (1 << LIMB) - 1
    return [(value >> (LIMB * k)) & mask for k in range(3)] + [value >> (LIMB * 3)]


def _sum_task(vector: str, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross = 0, 0, 0
        lo = np.full(dim, np.iinfo(np.int64).max)
        hi = np.full(dim, np.iinfo(np.int64).min)
        for batch in batches:
            for _, c in matrix_blocks(batch, vector, dim):
                x = integers(c)
                s, p = scatter(x)
                n, sums, cross = n + len(x), sums + s, cross + p
                lo, hi = np.minimum(lo, x.min(axis=0)), np.maximum(hi, x.max(axis=0))
        if not n:
            return
        rows = [(-1, -1, *_limbs(n), 0, 0)]
        rows += [(-1, j, *_limbs(sums[j]), int(lo[j]), int(hi[j])) for j in range(dim)]
        rows += [(i, j, *_limbs(cross[i, j]), 0, 0) for i in range(dim) for j in range(i, dim)]
        cols = [pa.array(c, pa.int32() if k < 2 else pa.int64()) for k, c in enumerate(zip(*rows))]
        yield pa.RecordBatch.from_arrays(cols, names=["i", "j", "l0", "l1", "l2", "l3", "lo", "hi"])

    return run


@dataclass
class Whitening:
    """``n`` rows with sums ``sums``; ``values`` and unit ``vectors`` (columns) of the
    covariance by falling eigenvalue, and its trace. ``exact_long``: whether every row's
    ``n x - S`` and its squares fit in longs."""

    dim: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    fits: tuple[bool, bool]

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(n x - S, whitened)`` of integer rows; null components are NaN."""
        kind = np.int64 if self.fits[0] else object
        centred = x.astype(kind) * self.n - np.array(self.sums, kind)
        with np.errstate(invalid="ignore", divide="ignore"):
            w = (centred.astype(np.float64) / self.n) @ self.vectors / np.sqrt(self.values)
        w[:, ~self.real] = np.nan
        return centred, w

    @property
    def real(self) -> np.ndarray:
        """Components that have variance."""
        return self.values > NO_VARIANCE * max(self.values[0], 0.0)


def fit(df: DataFrame, vector: str, dim: int, components: int) -> Whitening | None:
    """The whitening of usable vectors, from exact sums over all rows."""
    sums = (
        df.select(vector)
        .mapInArrow(_sum_task(vector, dim), _SUMS)
        .groupBy("i", "j")
        .agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(4)], F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .collect()
    )
    if not sums:
        return None
    value = {(r.i, r.j): sum(r[f"l{k}"] << (LIMB * k) for k in range(4)) for r in sums}
    n = value[-1, -1]
    s = [value[-1, j] for j in range(dim)]
    # Centred as integers; one correctly rounded division per entry after that.
    cov = np.empty((dim, dim))
    for i in range(dim):
        for j in range(i, dim):
            cov[i, j] = cov[j, i] = (n * value[i, j] - s[i] * s[j]) / (n * n)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    ends = {r.j: (r.lo, r.hi) for r in sums if r.i == -1 and r.j >= 0}
    far = [max(abs(n * e - s[j]) for e in ends[j]) for j in range(dim)]
    reach = max(n * max(abs(e) for j in range(dim) for e in ends[j]), *far, *(abs(v) for v in s))
    fits = reach < 2**63, sum(f * f for f in far) < 2**63
    return Whitening(dim, n, s, values[order], vectors[:, order], float(np.trace(cov)), fits)


def _moment_task(model: Whitening, vector: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, c in matrix_blocks(batch, vector, model.dim):
                w = np.nan_to_num(model.project(integers(c))[1])
                first, second = first + w.sum(axis=0), second + w.T @ w
        i, j = np.divmod(np.arange(k * k), k)
        i, j = np.append(np.full(k, -1), i), np.append(np.arange(k), j)
        cols = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.append(first, second.ravel()))]
        yield pa.RecordBatch.from_arrays(cols, names=["i", "j", "v"])

    return run


def identity_error(df: DataFrame, vector: str, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over the
    components that have variance."""
    sums = df.select(vector).mapInArrow(_moment_task(model, vector), "i int, j int, v double")
    got = {(r.i, r.j): r.v / model.n for r in sums.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    real = np.flatnonzero(model.real).tolist()
    return max((abs(got[i, j] - got[-1, i] * got[-1, j] - (i == j)) for i in real for j in real), default=0.0)


def _whiten_task(model: Whitening, ids: list[str], vector: str, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        share = np.where(model.real, model.values, 0.0) / (model.trace or 1.0)
        for batch in batches:
            for part, c in matrix_blocks(batch, vector, model.dim):
                m = len(c)
                centred, w = model.project(integers(c))
                if model.fits[1]:
                    dev = pa.array((centred**2).sum(axis=1)).cast(pa.decimal128(38, 0))
                else:
                    whole = [sum(v * v for v in row) for row in centred.astype(object).tolist()]
                    dev = pa.array([v if v < 10**38 else None for v in whole], pa.decimal128(38, 0))
                at = pa.array(np.repeat(np.arange(m), k))
                flat = w.ravel()
                cols = [part.column(part.schema.get_field_index(c_)).take(at) for c_ in ids] + [
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)),
                    dev.take(at),
                    pa.array(flat, mask=np.isnan(flat)),
                    pa.array(np.tile(share, m)),
                    pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=[*ids, *_OUT])

    return run


def whiten(
    df: DataFrame, ids: tuple[str, ...] = ("vec_id",), vector: str = "embedding", components: int = 8
) -> DataFrame:
    """One row per row of ``df`` with a usable vector and component, the ``components`` of
    greatest variance (fewer where the dimension is less): the ``ids``, ``component`` from
    1, ``n``, ``deviation`` (exact sum of ``(n x - S)^2``; null past 38 digits),
    ``whitened``, ``explained`` (share of the total variance) and ``identity_error``."""
    clash = set(ids) & {*_OUT, vector}
    if clash:
        raise ValueError(f"id columns named like other columns of the result: {sorted(clash)}")
    rows, dim = usable_vectors(df, vector, *ids)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in ids)
    schema = (
        f"{kept}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double"
    )
    model = fit(rows, vector, dim, components) if dim else None
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, vector, model)
    return rows.mapInArrow(_whiten_task(model, list(ids), vector, error), schema)
