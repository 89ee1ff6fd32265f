"""Ticks: record decoding, schema fill, quote unpivot, latest price.

PRJ-5/6, FN-3/4, GEN-2, AGG-3. Every function works on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from ..schemas import DEFAULT_TSYM, QUOTE_SCHEMA, RESPONSE_ERROR, SERVED_COLUMNS, TICK_SCHEMA, TIME_FORMAT
from .ordering import packed_order, ts_micros
from .quality import reject_class


def decode_ticks(df: DataFrame, column: str = "value") -> DataFrame:
    """PRJ-5, FN-3, PRJ-1: binary records of ``{"symbol", "close"}`` to columns.

    PERMISSIVE: garbage text gives a row of nulls, a wrong-typed field a null
    field; no record is dropped. Text is as good as binary.
    """
    tick = F.from_json(F.col(column).cast("string"), TICK_SCHEMA)
    return df.select(tick.alias("_tick")).select("_tick.*")


#: What can be wrong with a tick record.
TICK_REJECTS = ("malformed", "no_symbol", "bad_price")


def check_ticks(df: DataFrame, column: str = "value") -> DataFrame:
    """PRJ-5, FN-3 with FLT-3: every record as ``symbol, close, status`` and, unless it is
    ``ok``, its ``payload``.

    ``malformed``: the text is no JSON object (nor is a null record); ``no_symbol``: it names
    no symbol; ``bad_price``: its price is there, but no number (a number as text is one). A
    record without a price, or with a null one, is ``ok``: a tick that has none."""
    text = F.col(column).cast("string")
    kind = "symbol string, close string, _bad string"
    tick = F.from_json(text, kind, {"columnNameOfCorruptRecord": "_bad"})
    rows = df.select(text.alias("_text"), tick.alias("_t")).select("_text", "_t.*", F.col("_t").isNull().alias("_none"))
    price = F.col("close").try_cast("double")
    status = (
        F.when(F.col("_none") | F.col("_bad").isNotNull(), "malformed")
        .when(F.col("symbol").isNull(), "no_symbol")
        .when(F.col("close").isNotNull() & price.isNull(), "bad_price")
        .otherwise("ok")
    )
    out = rows.select("symbol", price.alias("close"), status.alias("status"), "_text")
    return out.select("symbol", "close", "status", F.when(F.col("status") != "ok", F.col("_text")).alias("payload"))


def add_ingest_time(df: DataFrame, source: str | Column | None = None) -> DataFrame:
    """FN-4: ``time`` as ``yyyy-MM-dd HH:mm:ss``.

    Without ``source`` it is the processing time, evaluated per micro-batch
    (quirk Q2: never a constant fixed when the plan is built).
    """
    ts = F.current_timestamp() if source is None else (F.col(source) if isinstance(source, str) else source)
    return df.withColumn("time", F.date_format(ts, TIME_FORMAT))


def fill_bar_schema(df: DataFrame) -> DataFrame:
    """PRJ-6: add the served columns a frame lacks, in served order.

    Missing price columns become ``0.0``; columns that are present keep their
    values (quirk Q1). A missing ``time``/``symbol`` becomes a null string.
    """
    fill = {
        c: (F.lit(None).cast(StringType()) if c in ("time", "symbol") else F.lit(0.0).cast(DoubleType()))
        for c in SERVED_COLUMNS
        if c not in df.columns
    }
    return df.withColumns(fill).select(*SERVED_COLUMNS, *[c for c in df.columns if c not in SERVED_COLUMNS])


# API-6: the record -> served tick chain.
TICK_TRANSFORMS = (decode_ticks, add_ingest_time, fill_bar_schema)


def parse_quotes(df: DataFrame, column: str = "payload") -> DataFrame:
    """A quote document parsed once: ``_quotes`` maps each top-level name to its text."""
    return df.withColumn("_quotes", F.from_json(F.col(column), QUOTE_SCHEMA))


def unpivot_quotes(df: DataFrame, column: str = "payload", tsym: str = DEFAULT_TSYM) -> DataFrame:
    """GEN-2 + FLT-2: ``{sym: {cur: price}}`` documents to ``(symbol, close)`` rows.

    Error envelopes are dropped (:func:`quote_rejects` has them). A quote without
    ``tsym``, or whose price is no number, gives a null close; prices may be text.
    """
    carry = [c for c in df.columns if c != column]
    parsed = parse_quotes(df, column)
    ok = parsed.where(is_not_error_col(F.try_element_at("_quotes", F.lit("Response"))))
    prices = F.from_json(F.col("_q"), QUOTE_SCHEMA)
    return ok.select(*carry, F.explode("_quotes").alias("symbol", "_q")).select(
        *carry, "symbol", F.try_element_at(prices, F.lit(tsym)).try_cast("double").alias("close")
    )


def quote_rejects(df: DataFrame, column: str = "payload") -> DataFrame:
    """FLT-2/3: the quote documents that :func:`unpivot_quotes` leaves out, whole, with
    ``status``: ``rate_limited``, ``other`` or ``malformed`` (no JSON object)."""
    parsed = parse_quotes(df, column)
    field = lambda name: F.try_element_at("_quotes", F.lit(name))
    status = F.when(F.col("_quotes").isNull(), "malformed").otherwise(reject_class(field("Message")))
    bad = F.col("_quotes").isNull() | ~is_not_error_col(field("Response"))
    return parsed.where(bad).withColumn("status", status).drop("_quotes")


def is_not_error_col(response: Column) -> Column:
    """FLT-2 on an arbitrary column."""
    return ~response.eqNullSafe(F.lit(RESPONSE_ERROR))


def latest_price(
    ticks: DataFrame,
    symbols: Sequence[str] | DataFrame | None = None,
    price: str = "price",
    ts: str = "ts",
    tiebreak: str | None = None,
    keys: Sequence[str] = ("symbol",),
) -> DataFrame:
    """AGG-3: latest price per symbol, optionally for a symbol list.

    A Python list becomes an IN filter pushed to the scan; a frame of symbols
    a left-semi join whose strategy (broadcast or shuffle) Catalyst picks from
    its measured size. The aggregation is hash-based with a map-side partial
    step, so a hot symbol reduces to one row per task before the shuffle.
    """
    df = ticks
    if isinstance(symbols, DataFrame):
        df = df.join(symbols.select(*keys).distinct(), list(keys), "left_semi")
    elif symbols is not None:
        df = df.where(F.col(keys[0]).isin(list(symbols)))
    order = packed_order(ts_micros(ts), F.col(tiebreak) if tiebreak else None)
    return df.groupBy(*keys).agg(
        F.max_by(price, order).alias("close"),
        F.date_format(F.max(ts), TIME_FORMAT).alias("time"),
    )

