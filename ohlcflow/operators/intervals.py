"""Closed ranges of whole numbers (epoch seconds): merging, joining, subtracting.

``[start, end]`` holds both ends; a range whose end lies before its start, or that lacks one,
is none. Joins are equi-joins on bins of a fixed width, so no plan has a nested loop: a range
is dealt to the bins it touches, and a pair meets in exactly one of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bin(c: Column, width: int) -> Column:
    return F.floor(c / F.lit(width)).cast("long") if width > 1 else c


def _merged(ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """Overlapping and touching ranges of each group as one, by sorting a group."""
    in_order = Window.partitionBy(*by).orderBy("start", "end")
    reach = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start") > reach + 1), 1).otherwise(0)
    rows = ranges.withColumn("_opens", opens)
    rows = rows.withColumn("_island", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*by, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def islands(ranges: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """``(*keys, start, end)``: the ranges of each key without overlaps; those that touch
    (one ends where the next begins, less one) are one.

    Merged twice: first within ``width`` of a key (by where a range starts), then what is left
    of a key. A key with very many ranges (every bar of a hot symbol) is so sorted in as many
    tasks as it has stretches of ``width``, and its last step sees about two ranges of each
    stretch plus its gaps."""
    rows = ranges.where("start <= end").select(*keys, "start", "end")
    near = rows.withColumn("_near", _bin(F.col("start"), width))
    return _merged(_merged(near, [*keys, "_near"]).drop("_near"), keys)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    width: int,
    left_range: tuple[str, str] = ("start", "end"),
    right_range: tuple[str, str] = ("start", "end"),
) -> DataFrame:
    """Pairs of rows of one key whose ranges share a number: the columns of ``left``, then
    those of ``right`` without the keys. Columns of the same name get the prefix ``right_``.

    ``width``: of the bins; the typical length of the shorter ranges is a good one (a range of
    length L is copied to about L / width bins). A pair that shares several bins is kept in
    that of the later start."""
    (ls, le), (rs, re) = left_range, right_range
    taken = {c for c in right.columns if c not in keys and c in left.columns}
    other = right.withColumnsRenamed({c: f"right_{c}" for c in taken})
    rs, re = (f"right_{c}" if c in taken else c for c in (rs, re))

    def dealt(df: DataFrame, s: str, e: str) -> DataFrame:
        bins = F.sequence(_bin(F.col(s), width), _bin(F.col(e), width))
        return df.where(F.col(s) <= F.col(e)).withColumn("_bin", F.explode(bins))

    met = dealt(left, ls, le).join(dealt(other, rs, re), [*keys, "_bin"])
    later = F.greatest(ls, rs)
    met = met.where((F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le)) & (F.col("_bin") == _bin(later, width)))
    return met.select(*left.columns, *[c for c in other.columns if c not in keys])


def subtract(
    wanted: DataFrame, have: DataFrame, keys: Sequence[str], ids: Sequence[str], width: int
) -> DataFrame:
    """What of every wanted range is in none of ``have``: the columns of ``wanted`` and
    ``gap_start``, ``gap_end``, one row per gap; a range that is covered has none.

    ``keys`` match the two, ``ids`` name a wanted range (keys included); ``have`` must be
    without overlaps (:func:`islands`). The parts that cover a range are walked in order, one
    window per range."""
    parts = interval_join(wanted.select(*ids, "start", "end"), have.select(*keys, "start", "end"), keys, width)
    parts = parts.select(
        *ids,
        "start",
        F.greatest("start", "right_start").alias("_from"),
        F.least("end", "right_end").alias("_to"),
    )
    in_order = Window.partitionBy(*ids).orderBy("_from")
    before = F.coalesce(F.lag("_to").over(in_order) + 1, F.col("start"))
    inner = parts.select(*ids, before.alias("gap_start"), (F.col("_from") - 1).alias("gap_end"))
    inner = inner.where("gap_start <= gap_end")
    last = parts.groupBy(*ids).agg(F.max("_to").alias("_last"))
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"o.{c}")) for c in ids]
    rows = wanted.where("start <= end")

    def beside(other: DataFrame, how: str) -> DataFrame:
        return rows.alias("w").join(other.alias("o"), same, how)

    tail = beside(last, "left").select(
        "w.*", F.coalesce(F.col("o._last") + 1, F.col("w.start")).alias("gap_start"), F.col("w.end").alias("gap_end")
    )
    return beside(inner, "inner").select("w.*", "o.gap_start", "o.gap_end").union(tail.where("gap_start <= gap_end"))
