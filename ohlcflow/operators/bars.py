"""Bars: payload flattening, OHLCV aggregation, last-N lookup, tiers, dedupe.

GEN-1, PRJ-1/2/3, FN-1/2, AGG-2, WIN-2, SET-3/4 and the Q5 dedupe.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import (
    BAR_COLUMNS,
    DAYS_BEFORE,
    OLDEST_DATE,
    ORDER_KEYS,
    PARTITION_COLUMNS,
    PRICE_COLUMNS,
    TIERS,
    TIME_FORMAT,
    YEARS_BEFORE,
)
from ..functions.timefn import epoch_to_text
from .intervals import interval_join, islands
from .ordering import packed_order, ts_micros

#: Width in seconds of the bins in which bars meet the stretches of their tier.
_SEGMENT = 30 * 86_400

_ENVELOPE = ("Response", "Message", "Data", "malformed")


def _carried(df: DataFrame, drop: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in drop]


def explode_payload(df: DataFrame) -> DataFrame:
    """GEN-1 + PRJ-1: one row per bar of ``Data.Data``; null or empty arrays give none.

    Columns other than the envelope (e.g. ``symbol``, ``batch_unit``) are carried.
    """
    carry = _carried(df, _ENVELOPE)
    return df.select(*carry, F.explode("Data.Data").alias("_bar")).select(*carry, "_bar.*")


def parse_bar_time(df: DataFrame, column: str = "time") -> DataFrame:
    """FN-1: epoch seconds (a number, or text of one) to ``yyyy-MM-dd HH:mm:ss`` text
    in the session zone; anything else gives null."""
    c = F.col(column)
    seconds = F.coalesce(c.try_cast("long"), c.try_cast("double").try_cast("long"))
    return df.withColumn(column, epoch_to_text(seconds))


def select_bar_columns(df: DataFrame) -> DataFrame:
    """PRJ-2: keep the bar columns, plus the partition columns when present."""
    keep = [c for c in PARTITION_COLUMNS if c in df.columns]
    return df.select(*BAR_COLUMNS, *keep)


def cast_prices(df: DataFrame, columns: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """PRJ-3 / FN-2: one projection of ``try_cast(... AS DOUBLE)``.

    Under ANSI mode a plain cast of bad text raises; ``try_cast`` yields null.
    """
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns if c in df.columns})


# API-5: the raw-payload -> bar chain.
BAR_TRANSFORMS = (explode_payload, parse_bar_time, select_bar_columns, cast_prices)


def bar_window(ts: str | Column, every: str) -> Column:
    """Tumbling bucket of width ``every`` (epoch aligned) as Spark's ``window``.

    Grouping by the window itself (not its start) keeps the event-time link a
    streaming watermark needs.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.window(c, every)


def ohlcv(
    ticks: DataFrame,
    every: str,
    ts: str = "ts",
    price: str = "price",
    keys: Sequence[str] = ("symbol",),
    qty: str | None = None,
    tiebreak: str | None = None,
    order_keys: bool = False,
) -> DataFrame:
    """AGG-2: OHLCV bars of width ``every`` (e.g. ``"1 hour"``, ``"3 hours"``).

    open/close are the first/last price in ``(ts, tiebreak)`` order, high/low the
    extremes, ``volumefrom`` the summed quantity (1 per tick without ``qty``) and
    ``volumeto`` the summed ``qty * price``. The ordering key is packed so the
    aggregation stays a HashAggregate with map-side partial aggregation: a hot
    symbol is reduced to one row per (partition, bucket) before the shuffle.
    Without ``tiebreak`` the key is the timestamp alone (a LONG, about 40%
    cheaper); use that only when times are unique per key, since ties are
    then broken arbitrarily. With ``order_keys`` a bar carries the places of its open and
    close (``open_key``, ``close_key``), so bars made of parts of the ticks can be put
    together (:func:`merge_partial_bars`).
    """
    order = packed_order(ts_micros(ts), F.col(tiebreak) if tiebreak else None)
    q = F.col(qty).cast("double") if qty else F.lit(1.0)
    p = F.col(price)
    return (
        ticks.groupBy(*keys, bar_window(ts, every).alias("_w"))
        .agg(
            F.max(p).alias("high"),
            F.min(p).alias("low"),
            F.min_by(p, order).alias("open"),
            F.max_by(p, order).alias("close"),
            F.sum(q).alias("volumefrom"),
            F.sum(q * p).alias("volumeto"),
            *([F.min(order).cast("decimal(38,0)").alias("open_key"), F.max(order).cast("decimal(38,0)").alias("close_key")] if order_keys else []),
        )
        .select(*keys, F.date_format("_w.start", TIME_FORMAT).alias("time"), *PRICE_COLUMNS, *(ORDER_KEYS if order_keys else []))
    )


def _put_together() -> dict[str, Column]:
    """Aggregates that make one bar of partial bars."""
    return {
        "high": F.max("high"),
        "low": F.min("low"),
        "open": F.min_by("open", "open_key"),
        "close": F.max_by("close", "close_key"),
        "volumefrom": F.sum("volumefrom"),
        "volumeto": F.sum("volumeto"),
    }


def merge_partial_bars(bars: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-2 over parts: bars that carry ``order_keys`` and are made of different ticks,
    put together per key: what one aggregation over all ticks would give. The result is
    mergeable again."""
    keyed = {"open_key": F.min("open_key"), "close_key": F.max("close_key")}
    return bars.groupBy(*keys).agg(*[c.alias(k) for k, c in {**_put_together(), **keyed}.items()])


def combine_parts(bars: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key of a table with mergeable bars: whole bars (``parts`` null), of which
    the latest ingested counts, and rows whose ``parts`` are entries ``PART_STRUCT``, of which
    per part the latest counts and all parts are put together. A whole bar shows before
    parts; both stay in ``parts`` then, the whole one as the entry without a ``part``. Other
    columns are the latest's.

    Two aggregations, by key and part, then by key: the list of parts is collected only after
    their versions are one, and has as many entries as a bar has makers."""
    held = {*keys, "parts", "ingest_seq", *PRICE_COLUMNS}
    extra = [c for c in bars.columns if c not in held]
    whole = bars.where("parts IS NULL").select(
        *keys, *extra, F.lit(None).cast("string").alias("part"), "ingest_seq", *PRICE_COLUMNS,
        *[F.lit(None).cast("decimal(38,0)").alias(c) for c in ORDER_KEYS],
    )
    parts = bars.where("parts IS NOT NULL").select(*keys, *extra, F.explode("parts").alias("_p")).select(
        *keys, *extra, "_p.part", F.col("_p.seq").alias("ingest_seq"), *[f"_p.{c}" for c in (*PRICE_COLUMNS, *ORDER_KEYS)]
    )
    each = dedupe_latest(whole.unionByName(parts), keys=(*keys, "part"), keep_order=True)
    is_whole = F.col("part").isNull()
    has_whole = F.max(is_whole)
    shown = [
        F.when(has_whole, F.max(F.when(is_whole, F.col(c)))).otherwise(made).alias(c)
        for c, made in _put_together().items()
    ]
    entry = F.struct("part", F.col("ingest_seq").alias("seq"), *ORDER_KEYS, *PRICE_COLUMNS)
    entries = F.when(F.min(is_whole), None).otherwise(F.array_sort(F.collect_list(entry)))
    order = packed_order(is_whole.cast("long"), F.col("ingest_seq"))
    latest = [F.max_by(c, order).alias(c) for c in extra]
    out = each.groupBy(*keys).agg(*shown, *latest, F.max("ingest_seq").alias("ingest_seq"), entries.alias("parts"))
    return out.select(*bars.columns)


def series_keys(bars: DataFrame) -> list[str]:
    """The columns that identify a series: the symbol, and the tier where there is one."""
    return [c for c in PARTITION_COLUMNS if c in bars.columns]


def resample_bars(bars: DataFrame, every: str, keys: Sequence[str] | None = None) -> DataFrame:
    """AGG-2 bar-to-bar: coarser bars from finer ones (times unique per key); a bar
    without a time is in none.

    ``keys``: by default the symbol, and the tier if the bars have one. Buckets of the
    fixed width ``every`` are epoch aligned, as the session's ``window`` has them. They are
    plain arithmetic, so no null check is pushed below the finer bars: a plan that uses
    those twice finds equal subplans and reads them once."""
    keys = series_keys(bars) if keys is None else keys
    t = ts_micros(F.try_to_timestamp("time", F.lit(TIME_FORMAT)))
    width = F.unix_micros(F.expr(f"TIMESTAMP '1970-01-01 00:00:00+00:00' + INTERVAL {every}"))
    return (
        bars.groupBy(*keys, (t - F.pmod(t, width)).alias("_w"))
        .agg(
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.min_by("open", t).alias("open"),
            F.max_by("close", t).alias("close"),
            F.sum("volumefrom").alias("volumefrom"),
            F.sum("volumeto").alias("volumeto"),
            F.max(t).alias("_last"),
        )
        .where(F.col("_last").isNotNull())
        .select(*keys, F.date_format(F.timestamp_micros("_w"), TIME_FORMAT).alias("time"), *PRICE_COLUMNS)
    )


def last_n_bars(
    bars: DataFrame,
    limit: int,
    to_ts: str | None = None,
    keys: Sequence[str] | None = None,
    time_col: str = "time",
    salt_buckets: int = 16,
) -> DataFrame:
    """WIN-2: the last ``limit`` bars at or before ``to_ts`` per key.

    ``keys``: by default the symbol, and the tier if the bars have one. ``to_ts`` is
    ``yyyy-MM-dd HH:mm:ss`` text, which orders like time, so on a stored table the
    filter reaches the scan (for bars made of ticks, bound those: :func:`ticks_until`).

    Two phases, both exact: first per (key, salt) over ``salt_buckets`` hash buckets
    of the time, then per key over at most ``limit * salt_buckets`` survivors, so a hot
    symbol is never sorted whole in one task. ``row_number() <= limit`` is planned with
    a WindowGroupLimit below the shuffle where Spark's threshold allows it.
    """
    df = bars if to_ts is None else bars.where(F.col(time_col) <= F.lit(to_ts))
    keys = series_keys(bars) if keys is None else keys
    order = F.col(time_col).desc()
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(time_col)), F.lit(salt_buckets)))
    first = Window.partitionBy(*keys, "_salt").orderBy(order)
    df = salted.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= limit).drop("_rn", "_salt")
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")


def _ntz(text: str) -> Column:
    """A constant of the tick tables' time type, which row groups are skipped by."""
    return F.lit(text).cast("timestamp_ntz")


def ticks_until(ticks: DataFrame, to_ts: str, every: str, ts: str = "ts") -> DataFrame:
    """The ticks of all bars of width ``every`` that begin at or before ``to_ts``
    (which is the beginning of a bar); the bound reaches the scan."""
    return ticks.where(F.col(ts) < _ntz(to_ts) + F.expr(f"INTERVAL {every}"))


def union_tiers(*frames: DataFrame) -> DataFrame:
    """SET-3: append-union of several resolutions by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tier_bounds(run_date: str) -> dict[str, Column]:
    """Date bounds of the three tiers for run date ``E`` (GEN-5 ranges).

    daily: OLDEST .. E-7y; hourly: E-7y+1d .. E-7d; minutely: E-6d 00:00 .. E 00:00.
    Years back are ``add_months(E, -12*7)`` (clamps once, quirk Q7).
    """
    e = F.to_date(F.lit(run_date))
    return {
        "oldest": F.to_date(F.lit(OLDEST_DATE)),
        "daily_end": F.add_months(e, -12 * YEARS_BEFORE),
        "hourly_end": F.date_sub(e, DAYS_BEFORE),
        "minutely_end": e.cast("timestamp"),
    }


def tier_ticks(ticks: DataFrame, batch_unit: str, run_date: str, ts: str = "ts") -> DataFrame:
    """SET-4 before aggregating: the ticks of the bars for which ``batch_unit`` is the
    covering tier. Constant bounds on ``ts`` reach the scan, so a tier reads only its
    range of the table; the bars themselves still go through :func:`select_tier`."""
    b = tier_bounds(run_date)
    day = lambda c: F.date_add(c, 1)
    low, high = {
        "daily": (b["oldest"], day(b["daily_end"])),
        "hourly": (day(b["daily_end"]), day(b["hourly_end"])),
        # The last minute bar begins at the bound itself.
        "minutely": (day(b["hourly_end"]), b["minutely_end"] + F.expr("INTERVAL 1 MINUTE")),
    }[batch_unit]
    t = F.col(ts)
    return ticks.where((t >= low.cast("timestamp_ntz")) & (t < high.cast("timestamp_ntz")))


def covering_tier(t: Column, run_date: str) -> Column:
    """SET-4: the finest tier that covers instant ``t``; null outside every range."""
    b = tier_bounds(run_date)
    d = F.to_date(t)
    return (
        F.when(d < b["oldest"], F.lit(None))
        .when(d <= b["daily_end"], F.lit("daily"))
        .when(d <= b["hourly_end"], F.lit("hourly"))
        .when(t.cast("timestamp") <= b["minutely_end"], F.lit("minutely"))
    )


def covering_tier_text(time_text: Column, run_date: str) -> Column:
    """SET-4 on ``yyyy-MM-dd HH:mm:ss`` text: same answer as
    :func:`covering_tier`, by comparing the text with constant-folded text
    bounds (the fixed format orders like time). No per-row parsing, and on a
    stored bar table the comparisons reach the parquet scan."""
    b = tier_bounds(run_date)

    def text(c: Column) -> Column:
        return F.date_format(c.cast("timestamp"), TIME_FORMAT)

    return (
        F.when(time_text < text(b["oldest"]), F.lit(None))
        .when(time_text < text(F.date_add(b["daily_end"], 1)), F.lit("daily"))
        .when(time_text < text(F.date_add(b["hourly_end"], 1)), F.lit("hourly"))
        .when(time_text <= text(b["minutely_end"]), F.lit("minutely"))
    )


def select_tier(bars: DataFrame, run_date: str, time_col: str = "time") -> DataFrame:
    """SET-4: keep each bar only if its ``batch_unit`` is the tier covering its time."""
    return bars.where(F.col("batch_unit") == covering_tier_text(F.col(time_col), run_date))


def tier_segments(ranges: DataFrame, width: int = _SEGMENT) -> DataFrame:
    """SET-4 with ranges as a table: which tier covers which seconds of a symbol.

    ``ranges``: ``symbol, batch_unit, start, end`` (closed, epoch seconds), overlapping as they
    like, also within a tier. The result has the same columns and no overlaps: where several
    tiers cover a second, the finest does. A tier that is none of ``TIERS`` covers nothing.

    The ranges' ends cut a symbol's time into pieces that no range covers in part; each piece
    takes the finest of the ranges over it, and pieces of one tier that touch are one."""
    rank = F.create_map(*[F.lit(x) for n, (name, _, _) in enumerate(TIERS) for x in (name, n)])
    ranked = ranges.where("start <= end").select(
        "symbol", F.try_element_at(rank, F.col("batch_unit")).alias("_rank"), "start", "end"
    )
    ranked = ranked.where("_rank IS NOT NULL AND symbol IS NOT NULL")
    cuts = ranked.select("symbol", "start").union(ranked.select("symbol", F.col("end") + 1)).distinct()
    after = F.lead("start").over(Window.partitionBy("symbol").orderBy("start"))
    pieces = cuts.withColumn("end", after - 1).where("end IS NOT NULL")
    over = interval_join(pieces, ranked, ["symbol"], width)
    finest = over.groupBy("symbol", "start", "end").agg(F.max("_rank").alias("_rank"))
    names = F.array(*[F.lit(name) for name, _, _ in TIERS])
    finest = finest.select("symbol", F.get(names, F.col("_rank")).alias("batch_unit"), "start", "end")
    return islands(finest, ["symbol", "batch_unit"], width)


def select_tier_by_ranges(bars: DataFrame, ranges: DataFrame, width: int = _SEGMENT) -> DataFrame:
    """SET-4 with ranges as a table: the bars whose tier is the finest that covers their time
    for their symbol. Bars and covered stretches meet by symbol, tier and bin of time; a bar
    lies in one bin and at most one stretch."""
    at = bars.withColumn("_at", F.unix_timestamp(F.try_to_timestamp("time", F.lit(TIME_FORMAT))))
    cover = tier_segments(ranges, width).withColumnsRenamed({"start": "_start", "end": "_end"})
    kept = interval_join(at, cover, ["symbol", "batch_unit"], width, ("_at", "_at"), ("_start", "_end"))
    return kept.select(*bars.columns)


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str] = ("symbol", "batch_unit", "time"),
    order_col: str = "ingest_seq",
    keep_order: bool = False,
) -> DataFrame:
    """Q5: one row per key, the one with the largest ``order_col`` (null: the smallest).

    Aggregation (not a window) so duplicates collapse map-side even when one key
    is hot. Ties on ``order_col`` are broken by a hash of the row so every
    column comes from the same row. With only fixed-width value columns the
    aggregation is hash-based; a string value column makes Spark use its
    sort-based aggregation (still partial, map-side). ``keep_order`` keeps the
    order column.
    """
    values = [c for c in df.columns if c not in keys and c != order_col]
    order = packed_order(F.col(order_col), F.xxhash64(*values) if values else None)
    # max_by of a null value keeps the null: the order itself is never null.
    latest = [F.max_by(c, order).alias(c) for c in values]
    if keep_order:
        latest.append(F.max(order_col).alias(order_col))
    return df.groupBy(*keys).agg(*latest).select(*[c for c in df.columns if keep_order or c != order_col])


def with_symbol(df: DataFrame, symbol: str) -> DataFrame:
    """PRJ-4 / FN-5: a constant ``symbol`` column for a single-symbol frame.

    The partitioned bar table already carries ``symbol`` from its folders.
    """
    return df.withColumn("symbol", F.lit(symbol))
