"""Sharding: contiguous minimax partition of ordered atomic groups.

Documents with equal text form one atomic group; groups are ordered by the
SHA-256 of their text (null text: a group of its own, first). The ``n_shards``
shards are contiguous runs of groups, and the largest shard is as small as any
such cut allows: the smallest feasible capacity is found by binary search, a
capacity being feasible when filling shards greedily in order needs no more than
``n_shards`` of them. The groups are then cut there.

Only sums reach the driver. Groups are summed by leading digits of their hash
into cells; treating cells as indivisible brackets the optimum, and with that
bracket only the cells in which a cut can fall matter. Those are split by
further digits, and so on until they hold single groups; the binary search over
the remaining cells is then exact. A group larger than every other shard together
is a cell like any other.

``slot`` numbers the documents of a shard from 0 without gaps, in an order of id
hashes: counts per (shard, hash cell) give each cell its offset, and rows are
numbered inside their cell only.

Edge cases: null and empty texts are two groups; their sizes are 1. Rows with
equal id are separate documents. Extra columns pass through. An empty table gives
an empty result; with fewer groups than shards the last shards stay empty.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, own_names, scratch

#: Hash digits (hexadecimal) of a cell at first, and those added by each split.
FIRST_DIGITS = 3
MORE_DIGITS = 2
#: Rows of a numbering cell.
SLOT_ROWS = 20_000


def text_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def group_key(text: Column) -> Column:
    """Hexadecimal SHA-256 of the text; a null text sorts first."""
    return F.coalesce(F.sha2(text, 256), F.lit("0" * 63 + "-"))


class _Cells:
    """Ordered cells ``(prefix, bytes, groups)`` with their prefix sums."""

    def __init__(self, cells: list[tuple[str, int, int]]):
        self.cells = sorted(cells)
        self.end = list(accumulate(c[1] for c in self.cells))

    def cut(self, start: int, capacity: int, lenient: bool) -> int:
        """Bytes up to the end of the shard that begins at ``start``. Strictly,
        whole cells only; leniently, a cell of several groups may be cut anywhere."""
        i = bisect_right(self.end, start + capacity)
        whole = self.end[i - 1] if i else 0
        if lenient and i < len(self.cells) and self.cells[i][2] > 1:
            return start + capacity
        return max(whole, start)

    def cuts(self, capacity: int, n: int, lenient: bool = False) -> list[int] | None:
        """Ends of the shards under ``capacity``, or None if ``n`` do not do."""
        total, at, out = self.end[-1] if self.end else 0, 0, []
        while at < total:
            nxt = self.cut(at, capacity, lenient)
            if nxt == at or len(out) == n:
                return None
            out.append(nxt)
            at = nxt
        return out

    def smallest(self, n: int, lenient: bool = False) -> int:
        """Binary search for the smallest feasible capacity."""
        lo, hi = 0, self.end[-1] if self.end else 0
        while lo < hi:
            mid = (lo + hi) // 2
            if self.cuts(mid, n, lenient) is None:
                lo = mid + 1
            else:
                hi = mid
        return lo


def _cells_of(groups: DataFrame, digits: int) -> list[tuple[str, int, int]]:
    """Sums by leading digits; as many rows as there are cells."""
    rows = (
        groups.groupBy(F.substring("key", 1, digits).alias("prefix"))
        .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("groups"))
        .collect()
    )
    return [(r["prefix"], int(r["bytes"]), int(r["groups"])) for r in rows]


def cut_keys(groups: DataFrame, n_shards: int) -> list[str]:
    """First key (or key prefix) of every shard but the first, for ``groups`` of
    ``(key, bytes)`` with one row per key: the minimax contiguous partition."""
    cells = _Cells(_cells_of(groups, FIRST_DIGITS))
    while True:
        # The optimum lies between cells cut at will and cells kept whole.
        low, high = cells.smallest(n_shards, lenient=True), cells.smallest(n_shards)
        late = cells.cuts(high, n_shards) or []
        at = 0
        spans = []
        for j in range(len(late)):
            # The optimum's cut is no nearer than whole cells under the low
            # capacity reach, and no further than j + 1 times the high one.
            at = cells.cut(at, low, False)
            spans.append((at, min((j + 1) * high, cells.end[-1])))
        open_ = [
            c
            for c, end in zip(cells.cells, cells.end)
            if c[2] > 1 and any(end - c[1] < hi and end > lo for lo, hi in spans)
        ]
        if low == high or not open_:
            break
        split = {c[0] for c in open_}
        finer = [c for c in cells.cells if c[0] not in split]
        for digits in {len(p) for p in split}:
            wanted = [p for p in split if len(p) == digits]
            finer += _cells_of(groups.where(F.substring("key", 1, digits).isin(wanted)), digits + MORE_DIGITS)
        cells = _Cells(finer)
    ends = cells.cuts(cells.smallest(n_shards), n_shards) or []
    first = {end: cells.cells[i + 1][0] for i, end in enumerate(cells.end[:-1])}
    return [first[e] for e in ends[:-1]]


@own_names("shard_size", "shard_key", "shard", "slot", "_cell", "_offset", "_n")
def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard_size`` (bytes), ``shard_key``, ``shard`` and ``slot``."""
    if n_shards < 1:
        raise ValueError("n_shards must be 1 at least")
    spark = docs.sparkSession
    with scratch(spark, "shard") as work:
        sized = docs.withColumns({"shard_size": text_size(F.col(text_col)), "shard_key": group_key(F.col(text_col))})
        rows = work.table(
            sized.select(F.col(id_col).alias("doc_id"), "shard_size", F.col("shard_key").alias("key")), "rows"
        )
        groups = work.table(rows.groupBy("key").agg(F.sum("shard_size").alias("bytes")), "groups")
        firsts = cut_keys(groups, n_shards)
        shard = F.lit(0)
        for first in firsts:
            shard = shard + (F.col("shard_key") >= F.lit(first)).cast("int")
        total = rows.count()
        n_cells = max(1, -(-total // (SLOT_ROWS * n_shards)))
        # Rows with equal id fall into cells by their text as well.
        cell = F.pmod(F.xxhash64(id_col, "shard_key"), F.lit(n_cells))
        placed = sized.withColumn("shard", shard).withColumn("_cell", cell)
        counts = (
            rows.select(F.col("doc_id").alias(id_col), F.col("key").alias("shard_key"))
            .withColumn("shard", shard)
            .withColumn("_cell", cell)
            .groupBy("shard", "_cell")
            .agg(F.count(F.lit(1)).alias("_n"))
        )
        before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        offsets = work.table(
            counts.select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")), "offsets"
        )
        inside = Window.partitionBy("shard", "_cell").orderBy(id_col, "shard_key")
        return (
            placed.join(broadcast_if_small(offsets), ["shard", "_cell"])
            .withColumn("slot", F.col("_offset") + F.row_number().over(inside) - 1)
            .select(*docs.columns, "shard_size", "shard_key", "shard", "slot")
        )
