"""Derive the reference's data shapes (FIXTURES F1-F9) from the driver tables.

Everything here is a Spark job over the given tables, so its work grows with
them. Groups that are collected into one value (payload documents, quote
requests) are bounded by construction: at most ``API_CHUNK_SIZE`` bars per
payload, ``QUOTE_CHUNK_SIZE`` symbols per quote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.text import escape_utf8
from .operators.ordering import packed_order, ts_micros
from .schemas import API_CHUNK_SIZE, QUOTE_CHUNK_SIZE, RATE_LIMIT_MESSAGE

# --- Fixed values of the fixtures (ours, not the reference's). ---
FAILED_SYMBOL = "error"          # events of this type stand for failed requests
OTHER_ERROR_MESSAGE = "invalid parameter"
PAYLOAD_BATCH_UNIT = "minutely"
# --- end of fixed values ---


def ticks(events: DataFrame) -> DataFrame:
    """Events as ticks: symbol = event_type, price = value."""
    return events.select(
        "event_id",
        "ts",
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        "user_id",
    )


# Every so many events a number comes as text, or a price is no number at all.
TEXT_NUMBER, NO_NUMBER = 5, 97
# Bars lie a minute apart, by event id: a series has one bar per time. 2024-01-01 UTC.
FIRST_MINUTE = 1_704_067_200


def bar_struct(events: DataFrame):
    """One provider bar per event (time in epoch seconds: a minute per event id), as JSON text.

    Variants by event id: prices and time as text, and a high that is ``n/a``."""
    v = F.col("value")
    bar = {
        "time": F.lit(FIRST_MINUTE) + F.col("event_id") * 60,
        "high": v,
        "low": v,
        "open": v,
        "close": v,
        "volumefrom": F.col("user_id").cast("double"),
        "volumeto": v * F.col("user_id"),
    }
    plain = F.to_json(F.struct(*[c.alias(k) for k, c in bar.items()]))
    text = F.to_json(F.struct(*[c.cast("string").alias(k) for k, c in bar.items()]))
    broken = F.to_json(F.struct(*[(F.lit("n/a") if k == "high" else c).alias(k) for k, c in bar.items()]))
    e = F.col("event_id")
    return F.when(e % NO_NUMBER == 0, broken).when(e % TEXT_NUMBER == 0, text).otherwise(plain)


def bar_payloads(events: DataFrame, chunk_size: int = API_CHUNK_SIZE) -> DataFrame:
    """one JSON document per (symbol, chunk of ``chunk_size`` event ids).

    ``FAILED_SYMBOL`` chunks become error envelopes without data: the
    rate-limit message for even chunks, another message for odd ones.
    Output: ``symbol, batch_unit, chunk_no, payload`` (payload is JSON text).
    """
    chunk = F.floor(F.col("event_id") / F.lit(chunk_size)).cast("long")
    grouped = events.groupBy(
        F.col("event_type").alias("symbol"), chunk.alias("chunk_no")
    ).agg(F.array_join(F.collect_list(bar_struct(events)), ",").alias("bars"))
    failed = F.col("symbol") == F.lit(FAILED_SYMBOL)
    message = F.when(F.col("chunk_no") % 2 == 0, F.lit(RATE_LIMIT_MESSAGE)).otherwise(F.lit(OTHER_ERROR_MESSAGE))
    error = F.to_json(F.struct(F.lit("Error").alias("Response"), message.alias("Message")))
    good = F.concat(F.lit('{"Response":"Success","Message":"","Data":{"Data":['), F.col("bars"), F.lit("]}}"))
    return grouped.select(
        "symbol",
        F.lit(PAYLOAD_BATCH_UNIT).alias("batch_unit"),
        "chunk_no",
        F.when(failed, error).otherwise(good).alias("payload"),
    )


# Event kinds the quote variants depend on, as small codes: a string value in
# ``max_by`` would force sort-based aggregation (variable-length buffer).
KIND_OTHER, KIND_ERROR, KIND_SIGNUP = 0, 1, 2


def _kind() -> Column:
    return (
        F.when(F.col("event_type") == "error", F.lit(KIND_ERROR))
        .when(F.col("event_type") == "signup", F.lit(KIND_SIGNUP))
        .otherwise(F.lit(KIND_OTHER))
    )


def latest_by_user(events: DataFrame) -> DataFrame:
    """Latest ``value`` and event kind per ``user_id`` (ties on ts broken by
    event_id), plus the packed order of that latest event (``_o``)."""
    order = packed_order(ts_micros("ts"), F.col("event_id"))
    return events.groupBy("user_id").agg(
        F.max_by("value", order).alias("value"),
        F.max_by(_kind(), order).alias("kind"),
        F.max(order).alias("_o"),
    )


def quote_payloads(events: DataFrame, chunk_size: int = QUOTE_CHUNK_SIZE) -> DataFrame:
    """multi-symbol quote documents ``{"<user_id>": {"USD": price}}``.

    Symbols are grouped ``chunk_size`` per document by ``user_id`` range.
    Variants: when the latest event is an ``error`` the quote lacks USD (only
    EUR); a ``signup`` quotes an integer price. Every third user's price is text, every
    nineteenth user's is ``n/a``.
    Output: ``chunk_no, payload``.
    """
    latest = latest_by_user(events)
    cur = F.when(F.col("kind") == KIND_ERROR, F.lit("EUR")).otherwise(F.lit("USD"))
    price = F.when(F.col("kind") == KIND_SIGNUP, F.floor("value").cast("double")).otherwise(
        F.col("value")
    )
    # Whole-number prices as integer literals ({"USD":6}), as the provider sends them.
    number = F.regexp_replace(F.to_json(F.struct(price.alias("p"))), r'^\{"p":(.*?)(?:\.0)?\}$', "$1")
    user = F.col("user_id")
    quote = F.when(user % 19 == 0, F.lit('"n/a"')).when(user % 3 == 0, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    entry = F.concat(F.lit('"'), user.cast("string"), F.lit('":{"'), cur, F.lit('":'), quote, F.lit("}"))
    chunk = F.floor(user / F.lit(chunk_size)).cast("long")
    doc = F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ","), F.lit("}"))
    return latest.groupBy(chunk.alias("chunk_no")).agg(doc.alias("payload"))


def quote_responses(events: DataFrame, chunk_size: int = QUOTE_CHUNK_SIZE) -> DataFrame:
    """F3 with envelopes: one response per quote request (``chunk_size`` users).

    When the latest event of a request's users is an ``error``, the response
    is an error envelope (the rate-limit message if that event's value is at
    least 50, another message otherwise); else it is the quote document.
    Output: ``chunk_no, payload``.
    """
    users = latest_by_user(events)
    entry = F.struct(
        F.col("user_id").cast("string").alias("k"), F.create_map(F.lit("USD"), F.col("value")).alias("v")
    )
    chunk = F.floor(F.col("user_id") / F.lit(chunk_size)).cast("long")
    per_chunk = users.groupBy(chunk.alias("chunk_no")).agg(
        F.to_json(F.map_from_entries(F.collect_list(entry))).alias("quotes"),
        F.max_by("kind", "_o").alias("last_kind"),
        F.max_by("value", "_o").alias("last_value"),
    )
    error = F.to_json(
        F.struct(
            F.lit("Error").alias("Response"),
            F.when(F.col("last_value") >= 50, F.lit(RATE_LIMIT_MESSAGE)).otherwise(F.lit(OTHER_ERROR_MESSAGE)).alias("Message"),
        )
    )
    return per_chunk.select(
        "chunk_no", F.when(F.col("last_kind") == KIND_ERROR, error).otherwise(F.col("quotes")).alias("payload")
    )


def tick_records(events: DataFrame) -> DataFrame:
    """stream records with a binary ``value`` holding tick JSON.

    Variants keyed on the ``props`` number k: k % 10 == 0 garbage text,
    k % 10 == 1 a text close (wrong type), k % 10 == 2 a null close.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    good = F.to_json(F.struct(F.col("event_type").alias("symbol"), F.col("value").alias("close")))
    wrong = F.to_json(
        F.struct(F.col("event_type").alias("symbol"), F.lit("n/a").alias("close"))
    )
    null_close = F.to_json(
        F.struct(F.col("event_type").alias("symbol"), F.lit(None).cast("double").alias("close")),
        {"ignoreNullFields": "false"},
    )
    text = (
        F.when(k % 10 == 0, F.concat(F.lit("not json "), F.col("event_id").cast("string")))
        .when(k % 10 == 1, wrong)
        .when(k % 10 == 2, null_close)
        .otherwise(good)
    )
    return events.select("event_id", "ts", text.cast("binary").alias("value"))


def coin_info(orders: DataFrame) -> DataFrame:
    """F8: market-cap records from orders: ``CoinInfo.Name`` = ``C<custkey>``.

    Customers whose key is a multiple of 97 carry no name (missing field).
    """
    mktcap = F.round(F.sum("o_totalprice"), 2)
    name = F.when(F.col("o_custkey") % 97 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    )
    return orders.groupBy("o_custkey").agg(mktcap.alias("mktcap")).select(
        F.struct(name.alias("Name")).alias("CoinInfo"), "mktcap", "o_custkey"
    )


def plan_symbols(nation: DataFrame) -> DataFrame:
    """nation names as the symbols of a backfill plan."""
    return nation.select(F.col("n_name").alias("symbol"))


#: Documents whose id is a multiple of this end in a byte that is no UTF-8.
BROKEN_DOCUMENT = 11


def escaped_documents(documents: DataFrame) -> DataFrame:
    """``b'...'`` byte-literal text of every document (whole text)."""
    whole = escape_utf8(F.col("text"))
    broken = F.regexp_replace(whole, "'$", r"\\xff'")
    return documents.select(
        "doc_id", F.when(F.col("doc_id") % BROKEN_DOCUMENT == 0, broken).otherwise(whole).alias("escaped")
    )
