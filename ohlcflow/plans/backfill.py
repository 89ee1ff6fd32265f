"""Backfill plan: symbols x tiers x chunks as one generated table (GEN-3/4/5).

The product is built with generators, not a join: every symbol row carries
the (constant-folded) array of its tier chunks, which ``explode`` turns into
rows, so the plan scales with the symbol table and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import years_before
from ..operators.intervals import islands, subtract
from ..schemas import API_CHUNK_SIZE, DAYS_BEFORE, DEFAULT_TSYM, OLDEST_DATE, TIERS, TIME_FORMAT, YEARS_BEFORE

_SECONDS_PER_DAY = 86400


def chunk_count(start: Column, end: Column, width: int) -> Column:
    """Chunks of a closed range: ``max(1, ceil((end - start + 1) / width))``."""
    return F.greatest(F.lit(1), F.ceil((end - start + F.lit(1)) / F.lit(width))).cast("long")


def date_chunks(start: Column, end: Column, width_days: int) -> Column:
    """GEN-3: closed, contiguous date chunks; the last one is clipped to ``end``.

    Array of ``struct(chunk_no, start, end)``.
    """
    n = chunk_count(F.lit(0), F.datediff(end, start), width_days)
    return F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda k: F.struct(
            k.alias("chunk_no"),
            F.date_add(start, (k * width_days).cast("int")).alias("start"),
            F.date_add(
                start, F.least((k + 1) * width_days - 1, F.datediff(end, start).cast("long")).cast("int")
            ).alias("end"),
        ),
    )


def second_chunks(start: Column, end: Column, width_seconds: int) -> Column:
    """GEN-4: the same over epoch seconds (``start``/``end`` are LONG seconds)."""
    n = chunk_count(start, end, width_seconds)
    return F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda k: F.struct(
            k.alias("chunk_no"),
            (start + k * width_seconds).alias("start"),
            F.least(start + (k + 1) * width_seconds - 1, end).alias("end"),
        ),
    )


def _epoch(d: Column) -> Column:
    return F.unix_timestamp(d.cast("timestamp"))


def _day_request(name: str, endpoint: str, per_day: int, aligned: bool):
    def request(c: Column) -> Column:
        days = F.datediff(c["end"], c["start"]) + (1 if aligned else 0)
        return F.struct(
            F.lit(name).alias("batch_unit"),
            F.lit(endpoint).alias("endpoint"),
            c["chunk_no"].alias("chunk_no"),
            _epoch(c["end"]).alias("toTs"),
            (days * per_day).cast("int").alias("limit"),
            _epoch(c["start"]).alias("start"),
            (_epoch(c["end"]) + (_SECONDS_PER_DAY - 1)).alias("end"),
            F.lit(_SECONDS_PER_DAY // per_day).alias("bar_seconds"),
        )

    return request


def tier_chunks(run_date: str, chunk_size: int = API_CHUNK_SIZE, mode: str = "reference") -> Column:
    """All request chunks of the three tiers for run date ``E``.

    ``mode="reference"`` keeps quirk Q6: ``limit`` counts whole days times bars
    per day (one short of a closed chunk) and the minute tier's ``toTs`` is the
    chunk start. ``mode="aligned"`` uses the chunk end and an inclusive count.
    Array of ``struct(batch_unit, endpoint, chunk_no, toTs, limit, start, end, bar_seconds)``,
    where ``start`` to ``end`` are the seconds a chunk covers.
    """
    if mode not in ("reference", "aligned"):
        raise ValueError(f"unknown mode {mode!r}")
    aligned = mode == "aligned"
    e = F.to_date(F.lit(run_date))
    tiers = {name: (endpoint, per_day) for name, endpoint, per_day in TIERS}
    out = []
    day_ranges = {
        "daily": (F.to_date(F.lit(OLDEST_DATE)), years_before(e, YEARS_BEFORE)),
        "hourly": (F.date_add(years_before(e, YEARS_BEFORE), 1), F.date_sub(e, DAYS_BEFORE)),
    }
    for name, (start, end) in day_ranges.items():
        endpoint, per_day = tiers[name]
        out.append(
            F.transform(
                date_chunks(start, end, chunk_size // per_day),
                _day_request(name, endpoint, per_day, aligned),
            )
        )
    endpoint, _ = tiers["minutely"]
    m_start = _epoch(F.date_add(F.date_sub(e, DAYS_BEFORE), 1))
    m_end = _epoch(e)
    width = chunk_size * 60
    out.append(
        F.transform(
            second_chunks(m_start, m_end, width),
            lambda c: F.struct(
                F.lit("minutely").alias("batch_unit"),
                F.lit(endpoint).alias("endpoint"),
                c["chunk_no"].alias("chunk_no"),
                (c["end"] if aligned else c["start"]).alias("toTs"),
                (
                    ((c["end"] - c["start"]) / 60 + 1).cast("int")
                    if aligned
                    else F.lit(chunk_size)
                ).alias("limit"),
                c["start"].alias("start"),
                c["end"].alias("end"),
                F.lit(60).alias("bar_seconds"),
            ),
        )
    )
    return F.concat(*out)


def backfill_plan(
    symbols: DataFrame,
    run_date: str,
    chunk_size: int = API_CHUNK_SIZE,
    aggregate: int = 1,
    tsym: str = DEFAULT_TSYM,
    mode: str = "reference",
    symbol: str = "symbol",
    ranges: bool = False,
) -> DataFrame:
    """GEN-5 + JON-1: one request row per (symbol, tier, chunk).

    Columns: ``symbol, batch_unit, endpoint, toTs, limit, aggregate, tsym,
    chunk_no``. ``(symbol, batch_unit, chunk_no)`` is the request key; no
    global counter is kept. With ``ranges`` also ``start``, ``end`` (seconds a request
    covers) and ``bar_seconds``, which :func:`remaining_plan` needs.
    """
    req = F.explode(tier_chunks(run_date, chunk_size, mode)).alias("r")
    return symbols.select(F.col(symbol).alias("symbol"), req).select(
        "symbol",
        "r.batch_unit",
        "r.endpoint",
        F.col("r.toTs").cast("long").alias("toTs"),
        F.col("r.limit").alias("limit"),
        F.lit(aggregate).cast("int").alias("aggregate"),
        F.lit(tsym).alias("tsym"),
        F.col("r.chunk_no").cast("int").alias("chunk_no"),
        *([F.col(f"r.{c}").cast("long").alias(c) for c in _RANGE] if ranges else []),
    )


_RANGE = ("start", "end", "bar_seconds")
#: Width of the bins in which ranges meet and are merged: about a chunk of each tier.
_NEAR = 2000 * 3600


def landed_ranges(bars: DataFrame) -> DataFrame:
    """The seconds that stored bars cover: ``symbol, batch_unit, start, end`` per bar. Bars
    without a time, or of a tier that has no width, cover nothing."""
    seconds = F.create_map(*[F.lit(x) for name, _, per_day in TIERS for x in (name, _SECONDS_PER_DAY // per_day)])
    start = F.unix_timestamp(F.try_to_timestamp("time", F.lit(TIME_FORMAT)))
    width = F.try_element_at(seconds, F.col("batch_unit"))
    rows = bars.select("symbol", "batch_unit", start.alias("start"), (start + width - 1).alias("end"))
    return rows.where("start IS NOT NULL AND end IS NOT NULL")


def remaining_plan(plan: DataFrame, landed: DataFrame, width: int = _NEAR) -> DataFrame:
    """GEN-5 on a rerun: the requests for what has not landed yet.

    ``plan``: requests with ``ranges``; ``landed``: ``symbol, batch_unit, start, end`` in any
    order, overlapping or not (:func:`landed_ranges`, or what requests say they returned). A
    request of which nothing has landed stays as it is; one that has landed is gone; of one
    that has landed in part every gap becomes a request of its own, for the whole bars in it:
    ``toTs`` is the last bar's time and ``limit`` their number. ``part_no`` counts the gaps of
    a request by time. A gap of less than a bar asks for nothing.

    Landed ranges are merged to islands, so what a request is compared with is its holes, not
    its bars; both sides meet in bins of ``width`` seconds."""
    keys = ["symbol", "batch_unit"]
    gaps = subtract(plan, islands(landed, keys, width), keys, [*keys, "chunk_no"], width)
    bar = F.col("bar_seconds")
    first = F.ceil(F.col("gap_start") / bar) * bar
    # The last whole bar ends with the gap or before.
    last = F.floor((F.col("gap_end") + 1) / bar - 1) * bar
    whole = (F.col("gap_start") == F.col("start")) & (F.col("gap_end") == F.col("end"))
    gaps = gaps.withColumns({"_first": first, "_last": last, "_whole": whole}).where("_whole OR _first <= _last")
    count = ((F.col("_last") - F.col("_first")) / bar + 1).cast("int")
    by_time = Window.partitionBy(*keys, "chunk_no").orderBy("gap_start")
    return gaps.select(
        *keys,
        "endpoint",
        F.when(F.col("_whole"), F.col("toTs")).otherwise(F.col("_last")).alias("toTs"),
        F.when(F.col("_whole"), F.col("limit")).otherwise(count).alias("limit"),
        "aggregate",
        "tsym",
        "chunk_no",
        (F.row_number().over(by_time) - 1).alias("part_no"),
    )
