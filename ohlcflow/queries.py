"""Registered queries: one per operator group of the survey inventory.

Each takes ``(spark, sf_dir)``, reads the driver tables under ``sf_dir`` (or
data Spark derives from them) in full, and returns a DataFrame; those that
rank, land files or run streams start jobs when called. The matching DuckDB SQL lives in :mod:`ohlcflow.oracle` with identical column
names. Sums of prices are rounded to cents, the precision of the inputs, so
summation order cannot change the value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures
from .apps import batch_stages, raw_to_bar_table
from .functions.schema import has_nested_column
from .functions.text import repaired_utf8
from .functions.timefn import (
    date_to_datetime,
    datetime_days_before,
    days_before,
    hours_before_midnight,
    months_before,
    parse_date,
    parse_datetime,
    to_epoch_seconds,
    today_kst,
    utc_to_kst_date,
    years_before,
)
from .jobs import apply_transforms, bind, run_stages
from .operators.asof import as_of, last_n_as_of
from .operators.bars import (
    BAR_TRANSFORMS,
    dedupe_latest,
    last_n_bars,
    ohlcv,
    resample_bars,
    select_tier,
    select_tier_by_ranges,
    tier_ticks,
    ticks_until,
    union_tiers,
    with_symbol,
)
from .operators.enrich import with_dimension
from .operators.quality import accept, classify
from .operators.ranking import chunk_symbols, rank_symbols, top_n
from .operators.setops import new_rows
from .operators.ticks import (
    add_ingest_time,
    decode_ticks,
    fill_bar_schema,
    latest_price,
    quote_rejects,
    unpivot_quotes,
)
from .plans.backfill import backfill_plan, landed_ranges, remaining_plan
from .schemas import BAR_ROW_SCHEMA, TIME_FORMAT
from .session import clean_scratch, scratch_path
from .sinks.writers import land_payloads, merge_bars, write_by_symbol, write_documents, write_ticks
from .sources.files import parse_payloads, read_bar_table, read_coin_info, read_quarantine, read_symbols
from .sources.stream import read_tick_stream
from .streaming.latest import latest_price_stream, read_latest_prices, start_latest_prices
from .streaming.ticks import (
    TICK_SINK_SCHEMA,
    compact_bar_sink,
    compact_tick_sink,
    dedupe_stream,
    dropped_as_late,
    ohlcv_stream,
    read_checked,
    read_latest_bars,
    read_sink,
    start_bar_upserts,
    start_checked_consumer,
    start_quote_producer,
    start_tick_consumer,
    tick_stream,
)

# --- Fixed query parameters. ---
RUN_DATE = "2022-03-20"          # backfill plan run date (FIXTURES F6)
RERUN_DATE = "2024-02-02"        # a run whose hours and minutes have events
TIER_RUN_DATE = "2024-01-28"     # run date whose tier ranges cut the event month
LAST_N = 24
REQUEST_BARS = 3
LAST_N_TO_TS = "2024-01-20 00:00:00"
TOP_N = 100
CHUNK = 10
TIER_WIDTHS = {"daily": "1 day", "hourly": "1 hour", "minutely": "1 minute"}
STREAM_FILES = 8
# Deliveries of the bar stream (even: neighbours are swapped).
DELIVERIES = 4
QUARANTINE_CHUNK = 100
# Disorder of the ticks of the latest-price stream, and silence that expires a symbol.
LATE_HOURS, EXPIRY_HOURS = 6, 12
# Orders before this make the symbol dimension's first version.
DIMENSION_DATE = "1996-01-01"
# Where the increments of the evolving table meet.
HALF = "2024-01-15 00:00:00"
PRUNED_SYMBOLS = ["003", "007", "009"]
ONE_SYMBOL = "click"
# --- end of fixed query parameters ---

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in cols})


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = fixtures.ticks(table(spark, sf_dir, "events"))
    return ohlcv(ticks, "1 hour", ts="ts", price="price", tiebreak="event_id")


def bars_from_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1 FLT-1 GEN-1 PRJ-1/2/3 FN-1/2: raw payload documents to bar rows."""
    payloads = fixtures.bar_payloads(table(spark, sf_dir, "events"))
    return apply_transforms(accept(parse_payloads(payloads)), BAR_TRANSFORMS)


def response_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1/3: payload counts per symbol and status (accepted / rate_limited / other)."""
    payloads = parse_payloads(fixtures.bar_payloads(table(spark, sf_dir, "events")))
    return classify(payloads).groupBy("symbol", "status").agg(F.count(F.lit(1)).alias("n_payloads"))


def ohlcv_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-2: hourly OHLCV bars per symbol from ticks."""
    return _cents(_hourly(spark, sf_dir), "volumeto")


def ohlcv_3h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-2: three-hour OHLCV bars per symbol from ticks."""
    ticks = fixtures.ticks(table(spark, sf_dir, "events"))
    return _cents(ohlcv(ticks, "3 hours", tiebreak="event_id"), "volumeto")


def bars_resample_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-2 bar-to-bar: daily bars rolled up from hourly bars."""
    return _cents(resample_bars(_hourly(spark, sf_dir), "1 day"), "volumeto")


def latest_price_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-3: latest price per user (ties on time broken by event id)."""
    ev = table(spark, sf_dir, "events")
    return latest_price(ev, price="value", keys=("user_id",), tiebreak="event_id")


def latest_price_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-3 with a symbol frame: latest price of the users who ever purchased."""
    ev = table(spark, sf_dir, "events")
    buyers = ev.where(F.col("event_type") == "purchase").select("user_id")
    return latest_price(ev, symbols=buyers, price="value", keys=("user_id",), tiebreak="event_id")


def last_n_bars_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-2: the last 24 hourly bars at or before a cut-off, per symbol."""
    ticks = ticks_until(fixtures.ticks(table(spark, sf_dir, "events")), LAST_N_TO_TS, "1 HOUR")
    hourly = ohlcv(ticks, "1 hour", tiebreak="event_id")
    return _cents(last_n_bars(hourly, LAST_N, to_ts=LAST_N_TO_TS), "volumeto")


def quote_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-2 FLT-2: multi-symbol quote documents to (symbol, close) rows."""
    return unpivot_quotes(fixtures.quote_payloads(table(spark, sf_dir, "events")))


def quote_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-2/3 on quote responses: lenient acceptance (only an explicit Error is
    rejected), rejects classified as rate_limited or other; counts per status."""
    docs = fixtures.quote_responses(table(spark, sf_dir, "events"))
    served = unpivot_quotes(docs).select("chunk_no", F.lit("accepted").alias("status")).distinct()
    rejected = quote_rejects(docs).select("chunk_no", "status")
    return served.union(rejected).groupBy("status").agg(F.count(F.lit(1)).alias("n_docs"))


def symbol_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 / WIN-1: every customer ranked by order total (ties by key)."""
    return _ranked_customers(table(spark, sf_dir, "orders"))


def _ranked_customers(orders: DataFrame) -> DataFrame:
    totals = orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    ranked = rank_symbols(totals, value="total", key="o_custkey")
    return ranked.select("rank", F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), "total")


def symbol_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-1 AGG-4: ranked symbols in request chunks of 10, joined in rank order."""
    return chunk_symbols(symbol_dimension(spark, sf_dir), CHUNK)


def kst_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-7: Seoul calendar date of every event."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", utc_to_kst_date("ts").alias("kst_date"))


def backfill_plan_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-3/4/5 JON-1: request plan for nation names as symbols, run date 2022-03-20."""
    return backfill_plan(fixtures.plan_symbols(table(spark, sf_dir, "nation")), RUN_DATE)


def _landed_so_far(ev: DataFrame) -> DataFrame:
    """What a first run has brought: hours and minutes that have events; and on every third
    day of the year whole deliveries, from a symbol's first hour to its last, over the hours."""
    hour = F.date_format(F.date_trunc("hour", "ts"), TIME_FORMAT)
    minute = F.date_format(F.date_trunc("minute", "ts"), TIME_FORMAT)
    symbol = F.col("event_type").alias("symbol")
    bars = ev.select(symbol, F.lit("hourly").alias("batch_unit"), hour.alias("time")).union(
        ev.select(symbol, F.lit("minutely"), minute)
    )
    seconds = F.unix_timestamp(F.date_trunc("hour", "ts").cast("timestamp"))
    days = ev.where(F.dayofyear("ts") % 3 == 0).groupBy(symbol, F.to_date("ts").alias("day"))
    whole = days.agg(F.min(seconds).alias("start"), (F.max(seconds) + 3599).alias("end"))
    return landed_ranges(bars).union(whole.select("symbol", F.lit("hourly"), "start", "end"))


def remaining_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-5 SNK-6 on a rerun: nations have landed nothing; event kinds have landed hours and
    minutes with holes, in overlapping deliveries, and chunks in part: what is still to ask."""
    ev = table(spark, sf_dir, "events")
    symbols = fixtures.plan_symbols(table(spark, sf_dir, "nation")).union(ev.select("event_type").distinct())
    return remaining_plan(backfill_plan(symbols, RERUN_DATE, ranges=True), _landed_so_far(ev))


def fill_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-6 FN-4: ticks widened to the served bar schema (event time as time)."""
    ev = table(spark, sf_dir, "events")
    ticks = ev.select(F.col("event_type").alias("symbol"), F.col("value").alias("close"), "ts")
    return fill_bar_schema(add_ingest_time(ticks, source="ts")).drop("ts")


def tick_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-5 FN-3: binary tick records (with garbage/wrong-type/null variants) decoded."""
    records = fixtures.tick_records(table(spark, sf_dir, "events"))
    return decode_ticks(records)


def multiset_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-1: (user, type) multiset minus the one of cheap events."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    cheap = ev.where(F.col("value") < 10).select("user_id", "event_type")
    return new_rows(ev.select("user_id", "event_type"), cheap)


def tier_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-3: daily, hourly and minutely bars in one frame keyed by batch_unit. Hours are
    rolled up from minutes and days from hours, so the ticks are read and dealt once."""
    ticks = fixtures.ticks(table(spark, sf_dir, "events"))
    minutely = ohlcv(ticks, TIER_WIDTHS["minutely"], tiebreak="event_id")
    hourly = resample_bars(minutely, TIER_WIDTHS["hourly"])
    daily = resample_bars(hourly, TIER_WIDTHS["daily"])
    tiers = {"daily": daily, "hourly": hourly, "minutely": minutely}
    return _cents(union_tiers(*[df.withColumn("batch_unit", F.lit(u)) for u, df in tiers.items()]), "volumeto")


def tier_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-4: per instant, only the bars of the tier that covers it (run date 2024-01-28).
    Each tier aggregates only the ticks of its range, which the scan is told."""
    ticks = fixtures.ticks(table(spark, sf_dir, "events"))
    tiers = [
        ohlcv(tier_ticks(ticks, unit, TIER_RUN_DATE), every, tiebreak="event_id").withColumn("batch_unit", F.lit(unit))
        for unit, every in TIER_WIDTHS.items()
    ]
    return _cents(select_tier(union_tiers(*tiers), TIER_RUN_DATE), "volumeto")


def tier_ranges(events: DataFrame) -> DataFrame:
    """Overlapping tier ranges of every symbol, by the day of its first event and the length of
    its name: days from the start, hours from later on (a second stretch of them within the
    minutes), minutes of the last days."""
    first = F.unix_timestamp(F.date_trunc("day", F.min("ts")).cast("timestamp"))
    per = events.groupBy(F.col("event_type").alias("symbol")).agg(first.alias("s"), F.length("event_type").alias("k"))
    day = lambda n: F.col("s") + n * 86_400
    k = F.col("k")
    tiers = [
        ("daily", day(F.lit(0)), day(F.lit(20)) - 1),
        ("hourly", day(k), day(k + 10) + 1799),
        ("hourly", day(F.lit(18)), day(F.lit(26))),
        ("minutely", day(20 + k % 3), day(F.lit(25)) - 1),
        ("minutely", day(F.lit(24)), day(F.lit(28))),
    ]
    cells = [F.struct(F.lit(u).alias("batch_unit"), a.alias("start"), b.alias("end")) for u, a, b in tiers]
    return per.select("symbol", F.explode(F.array(*cells)).alias("r")).select("symbol", "r.*")


def tier_select_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SET-4 with ranges as a table: bars of the finest tier that covers them, per symbol."""
    ev = table(spark, sf_dir, "events")
    ticks = fixtures.ticks(ev)
    tiers = [
        ohlcv(ticks, every, tiebreak="event_id").withColumn("batch_unit", F.lit(unit))
        for unit, every in TIER_WIDTHS.items()
    ]
    return _cents(select_tier_by_ranges(union_tiers(*tiers), tier_ranges(ev)), "volumeto")


def latest_price_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-3 for a table of instants: at every purchase of every user, the price and time of
    the user's last event of another kind."""
    ev = table(spark, sf_dir, "events")
    bought = F.col("event_type") == "purchase"
    at = ev.where(bought).select("event_id", "user_id", F.col("ts").alias("at"))
    found = as_of(at, ev.where(~bought), ["user_id"], ["value"], tiebreak="event_id")
    times = {c: F.date_format(c, TIME_FORMAT) for c in ("at", "as_of")}
    return found.withColumns(times).withColumnRenamed("value", "close")


def last_n_bars_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WIN-2 with a ``toTs`` per request: the last three hourly bars of a user at or before each
    of the user's purchases."""
    ev = table(spark, sf_dir, "events")
    ticks = ev.select("event_id", "ts", "user_id", F.col("value").alias("price"))
    bars = ohlcv(ticks, "1 hour", keys=("user_id",), tiebreak="event_id")
    bars = bars.withColumn("ts", F.to_timestamp("time", TIME_FORMAT))
    asked = ev.where("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("to_ts"))
    found = last_n_as_of(asked, bars, REQUEST_BARS, ["user_id"], ["event_id", "user_id"])
    return _cents(found.drop("ts"), "volumeto")


def top_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TOP-1 LIM-1 PRJ-8: top 100 by market cap, nested ``CoinInfo.Name``."""
    info = fixtures.coin_info(table(spark, sf_dir, "orders"))
    top = top_n(info, TOP_N, [F.col("mktcap").desc(), F.col("o_custkey").asc()])
    return top.select(F.col("CoinInfo.Name").alias("name"), "mktcap")


def calendar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-8..14: month/year/day/hour steps, midnight, epoch and text parsing per order."""
    o = table(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    fmt = "yyyy-MM-dd"
    return o.select(
        "o_orderkey",
        F.date_format(months_before(d, 1), fmt).alias("month_before"),
        F.date_format(months_before(d, 3), fmt).alias("months_before_3"),
        F.date_format(years_before(d, 7), fmt).alias("years_before_7"),
        F.date_format(days_before(d, 7), fmt).alias("days_before_7"),
        F.date_format(datetime_days_before(d, 7), "yyyy-MM-dd HH:mm:ss").alias("midnight_before_7"),
        F.date_format(hours_before_midnight(d, 5), "yyyy-MM-dd HH:mm:ss").alias("hours_before_5"),
        F.date_format(date_to_datetime(d), "yyyy-MM-dd HH:mm:ss").alias("midnight"),
        to_epoch_seconds(d).alias("epoch"),
        F.date_format(parse_date(F.date_format(d, "yyyy/MM/dd")), fmt).alias("parsed"),
    )


# --- Fixed values of the parse_dates query: one text format per order priority. ---
PRIORITY_FORMATS = {
    "1-URGENT": "yyyy-MM-dd HH:mm:ss",
    "2-HIGH": "yyyy-MM-dd'T'HH:mm:ss",
    "3-MEDIUM": "yyyy/MM/dd",
    "4-NOT SPECIFIED": "yyyyMMdd",
    "5-LOW": "yyyy-MM-dd'T'HH:mm:ss.SSS'+09:00'",
}
# --- end of fixed values ---


#: Orders whose key is a multiple of this have text that is no date.
BAD_DATE = 101


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-12/13: order dates rendered as text in a format chosen by priority,
    parsed back without knowing the format, then taken to midnight."""
    o = table(spark, sf_dir, "orders")
    text = F.lit(None).cast("string")
    for priority, fmt in PRIORITY_FORMATS.items():
        text = F.when(F.col("o_orderpriority") == priority, F.date_format("o_orderdate", fmt)).otherwise(text)
    # A few texts are no dates at all.
    text = F.when(F.col("o_orderkey") % BAD_DATE == 0, F.concat(F.lit("n/a "), text)).otherwise(text)
    parsed = parse_date(text)
    return o.select(
        "o_orderkey",
        text.alias("text"),
        F.date_format(parsed, "yyyy-MM-dd").alias("order_date"),
        F.date_format(date_to_datetime(parsed), "yyyy-MM-dd HH:mm:ss").alias("midnight"),
    )


# --- Fixed values of the parse_free_dates query: a form per order key modulo their number. ---
FREE_FORMS = (
    "MMM d, yyyy h:mm a",
    "d MMMM yyyy",
    "EEE, dd MMM yyyy HH:mm:ss 'GMT'",
    "EEE MMM d HH:mm:ss yyyy",
    "MM/dd/yyyy",
    "dd.MM.yyyy HH:mm",
    "yyyyMMddHHmmss",
    "dd-MMM-yy",
    "yyyy MMM dd",
    "MMMM d'th', yyyy",
    "d MMM yyyy HH:mm:ss 'KST'",
    "yyyy.MM.dd",
    "M/d/yy h:mm:ss a",
    "h:mm a 'at' d MMM yyyy",
    "'Feb 30,' yyyy",
    "d MMM yyyy HH:mm 'XYZ'",
)
# --- end of fixed values ---


def parse_free_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-12: every order's time written in one of sixteen free forms, two of them no dates, and
    parsed without knowing the form."""
    o = table(spark, sf_dir, "orders")
    at = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)
    form = F.col("o_orderkey") % len(FREE_FORMS)
    text = F.lit(None).cast("string")
    for n, fmt in enumerate(FREE_FORMS):
        text = F.when(form == n, F.date_format(at, fmt)).otherwise(text)
    rows = o.select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", "text", F.date_format(parse_datetime(F.col("text")), TIME_FORMAT).alias("parsed"))


def text_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FN-15: every document escaped to a byte literal and repaired (whole texts); every
    eleventh also gets a byte that is no UTF-8 and must come back null and flagged."""
    esc = fixtures.escaped_documents(table(spark, sf_dir, "documents"))
    both = esc.select("doc_id", "escaped", repaired_utf8(F.col("escaped")).alias("r"))
    return both.select("doc_id", "escaped", "r.text", "r.broken")


def nested_field_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-1: parse ``props`` with a declared struct and flatten it."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.*")


def bars_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: hourly bars ingested twice (the second run corrects ``view`` closes);
    one row per (symbol, batch_unit, time), the latest ingest wins."""
    first = _hourly(spark, sf_dir).withColumns({"batch_unit": F.lit("hourly"), "ingest_seq": F.lit(1)})
    second = first.withColumns(
        {
            "ingest_seq": F.lit(2),
            "close": F.when(F.col("symbol") == "view", F.col("close") + 1).otherwise(F.col("close")),
        }
    )
    return _cents(dedupe_latest(first.unionByName(second)), "volumeto")


def _land_stream_files(spark: SparkSession, df: DataFrame, name: str, files: int) -> str:
    """Write ``df`` as ``files`` parquet files split by time range (stream input)."""
    path = scratch_path(spark, name)
    df.repartitionByRange(files, "ts").write.parquet(path)
    return path


def stream_ticks_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-3/4 STR-1/2 SNK-3: tick records as a file stream (one file per trigger),
    the batch tick chain, a foreachBatch sink routed by symbol; the sink's small folders
    compacted (twice: the second time adds nothing), the table read back. The ingest time
    (FN-4) must lie within the run."""
    records = fixtures.tick_records(table(spark, sf_dir, "events"))
    src = _land_stream_files(spark, records, "tick-src", STREAM_FILES)
    sink, compact = scratch_path(spark, "tick-sink"), scratch_path(spark, "tick-table")
    began = spark.range(1).select(F.date_trunc("second", F.current_timestamp())).first()[0]
    stream = read_tick_stream(spark, fmt="parquet", path=src, max_files_per_trigger=1)
    q = start_tick_consumer(tick_stream(stream), sink, f"{sink}-ckpt", fmt="parquet")
    q.awaitTermination()
    for _ in range(2):
        compact_tick_sink(spark, sink, compact)
    ended = spark.range(1).select(F.current_timestamp()).first()[0]
    clean_scratch(spark, src, sink, f"{sink}-ckpt")
    time = F.to_timestamp("time", TIME_FORMAT)
    return (
        read_sink(spark, compact, schema=TICK_SINK_SCHEMA)
        .withColumn("time_in_run", (time >= F.lit(began)) & (time <= F.lit(ended)))
        .drop("time", "batch_id", "run", "written_at")
    )


def stream_quote_producer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR-3 SNK-5 GEN-2: quote documents landed as text files, unpivoted by a
    streaming producer into ``{"symbol","close"}`` records, read back."""
    quotes, out = scratch_path(spark, "quotes"), scratch_path(spark, "quote-ticks")
    fixtures.quote_payloads(table(spark, sf_dir, "events")).select("payload").write.text(quotes)
    start_quote_producer(spark, quotes, out, f"{out}-ckpt", trigger="availableNow").awaitTermination()
    clean_scratch(spark, quotes, f"{out}-ckpt")
    return spark.read.schema("value string").json(out).select(
        F.from_json("value", "symbol string, close double").alias("t")
    ).select("t.*")


def stream_dedupe_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream dedupe (at-least-once delivery): every tick record arrives, then the whole
    set arrives again after a restart from the checkpoint. The watermark spans the
    deliveries, so no copy is late and the dedupe state has to remove every one."""
    records = fixtures.tick_records(table(spark, sf_dir, "events"))
    src, sink = scratch_path(spark, "dup-src"), scratch_path(spark, "dup-sink")
    late = 0
    for _ in range(2):
        records.write.mode("append").parquet(src)
        stream = spark.readStream.schema(records.schema).parquet(src)
        unique = dedupe_stream(stream, ["event_id"], "ts", "3650 days")
        q = start_tick_consumer(tick_stream(unique), sink, f"{sink}-ckpt", fmt="parquet")
        q.awaitTermination()
        late += dropped_as_late(q)
    clean_scratch(spark, src, f"{sink}-ckpt")
    return (
        read_sink(spark, sink, schema=TICK_SINK_SCHEMA)
        .drop("time", "batch_id", "run", "written_at")
        .withColumn("dropped_as_late", F.lit(late).cast("long"))
    )


def stream_dedupe_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15 with state that expires: deliveries by time, each repeating the six hours before it,
    half a day of watermark; the last also repeats the first day, weeks late. Every record comes
    out once, and what is behind the watermark is counted, not served again."""
    records = fixtures.tick_records(table(spark, sf_dir, "events"))
    lo, hi = records.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / DELIVERIES
    src, sink = scratch_path(spark, "expiry-src"), scratch_path(spark, "expiry-sink")
    late = 0
    for n in range(DELIVERIES):
        since = lo + step * n - timedelta(hours=LATE_HOURS)
        part = records.where(F.col("ts") >= F.lit(since))
        if n < DELIVERIES - 1:
            part = part.where(F.col("ts") < F.lit(lo + step * (n + 1)))
        else:
            part = part.union(records.where(F.to_date("ts") == F.lit(lo.date())))
        part.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(records.schema).parquet(src)
        unique = dedupe_stream(stream, ["event_id"], "ts", f"{2 * LATE_HOURS} hours")
        q = start_tick_consumer(tick_stream(unique), sink, f"{sink}-ckpt", fmt="parquet")
        q.awaitTermination()
        late += dropped_as_late(q)
    clean_scratch(spark, src, f"{sink}-ckpt")
    out = read_sink(spark, sink, schema=TICK_SINK_SCHEMA).drop("time", "batch_id", "run", "written_at")
    return out.withColumn("dropped_as_late", F.lit(late).cast("long"))


def stream_ohlcv_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-2 on a stream: hourly bars with a watermark in update mode.

    Ticks arrive in deliveries by time, each pair of neighbours in the wrong order, so
    half of the ticks are late but within the watermark. After each delivery the query is
    restarted from its checkpoint with ``availableNow`` (as after downtime), its
    micro-batch upserted; the sink is read back latest-wins.
    """
    ticks = fixtures.ticks(table(spark, sf_dir, "events")).drop("user_id")
    lo, hi = ticks.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / DELIVERIES
    src, sink = scratch_path(spark, "bar-src"), scratch_path(spark, "bar-sink")
    watermark = f"{int(2 * step.total_seconds()) + 3600} seconds"
    for i in [k ^ 1 for k in range(DELIVERIES)]:
        start = lo + step * i
        part = ticks.where(F.col("ts") >= F.lit(start))
        part = part.where(F.col("ts") < F.lit(lo + step * (i + 1))) if i < DELIVERIES - 1 else part
        part.write.mode("append").parquet(src)
        stream = spark.readStream.schema(ticks.schema).parquet(src)
        bars = ohlcv_stream(stream, "1 hour", watermark, tiebreak="event_id")
        start_bar_upserts(bars, sink, f"{sink}-ckpt").awaitTermination()
    clean_scratch(spark, src, f"{sink}-ckpt")
    return _cents(read_latest_bars(spark, sink), "volumeto").select(*_hourly(spark, sf_dir).columns)


def stream_latest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG-3 on a stream: the last price of every user, in keyed state. Ticks arrive in
    deliveries up to six hours out of order, the query is restarted from its checkpoint after
    each; the last delivery repeats the first day's ticks at another price, weeks late. Users
    without a tick for half a day before the watermark are expired."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", F.col("user_id").alias("symbol"), F.col("value").alias("price"))
    arrival = F.unix_timestamp(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(LATE_HOURS * 3600 - 1))
    lo, hi = ev.agg(F.min(arrival), F.max(arrival)).first()
    part = F.least(F.floor((arrival - lo) * DELIVERIES / (hi - lo + 1)), F.lit(DELIVERIES - 1))
    first_day = F.to_date("ts") == ev.select(F.to_date(F.min("ts"))).first()[0]
    src, sink = scratch_path(spark, "last-src"), scratch_path(spark, "last-sink")
    for n in range(DELIVERIES):
        rows = ev.where(part == n)
        if n == DELIVERIES - 1:
            rows = rows.union(ev.where(first_day).withColumn("price", F.col("price") + 1000))
        rows.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ev.schema).parquet(src)
        latest = latest_price_stream(stream, f"{LATE_HOURS} hours", EXPIRY_HOURS * 3600, tiebreak="event_id")
        start_latest_prices(latest, sink, f"{sink}-ckpt").awaitTermination()
    clean_scratch(spark, src, f"{sink}-ckpt")
    return read_latest_prices(spark, sink)


def stream_enriched_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-4 F7: ticks of customers joined with the symbol dimension as it is when their batch
    comes. Between the halves of the ticks the dimension is replaced: ranks by the orders of
    the first years, then by all."""
    ev = table(spark, sf_dir, "events")
    orders = table(spark, sf_dir, "orders")
    symbol = F.concat(F.lit("C"), F.col("user_id").cast("string"))
    ticks = ev.select("event_id", "ts", symbol.alias("symbol"), F.col("value").alias("close"))
    src, sink, dim = (scratch_path(spark, f"enriched-{x}") for x in ("src", "sink", "dim"))
    enrich = bind(with_dimension, dim, ["rank", "total"])
    before = F.col("ts") < F.lit(HALF).cast("timestamp_ntz")
    for known, half in ((orders.where(F.col("o_orderdate") < F.lit(DIMENSION_DATE)), before), (orders, ~before)):
        _ranked_customers(known).write.mode("overwrite").parquet(dim)
        ticks.where(half).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ticks.schema).parquet(src)
        start_tick_consumer(
            stream.drop("ts"), sink, f"{sink}-ckpt", fmt="parquet", enrichments=(enrich,), by=()
        ).awaitTermination()
    clean_scratch(spark, src, dim, f"{sink}-ckpt")
    schema = "event_id long, symbol string, close double, rank long, total double, run string, batch_id long"
    return spark.read.schema(schema).parquet(sink).drop("run", "batch_id")


def stream_tick_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1/3 on a stream: served ticks and rejects of every micro-batch in one write, the query
    started twice; what was served, and whole rejects, counted by status and symbol."""
    records = fixtures.tick_records(table(spark, sf_dir, "events"))
    src, sink = _land_stream_files(spark, records, "checked-src", STREAM_FILES), scratch_path(spark, "checked-sink")
    for _ in range(2):
        stream = read_tick_stream(spark, fmt="parquet", path=src, max_files_per_trigger=2)
        start_checked_consumer(stream, sink, f"{sink}-ckpt").awaitTermination()
    clean_scratch(spark, src, f"{sink}-ckpt")
    good = read_checked(spark, sink).select(F.lit("ok").alias("status"), "symbol", "close", F.lit(0).alias("size"))
    bad = read_checked(spark, sink, rejects=True).select("status", "symbol", "close", F.length("payload").alias("size"))
    cents = F.round(F.sum("close"), 2).alias("total")
    return good.union(bad).groupBy("status", "symbol").agg(F.count(F.lit(1)).alias("n"), cents, F.sum("size").alias("characters"))


def sink_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-3: a second query with a checkpoint of its own writes to the sink of a first
    one; both start at batch 0 and neither touches the other's rows."""
    records = fixtures.tick_records(table(spark, sf_dir, "events"))
    sink = scratch_path(spark, "two-sink")
    for part in range(2):
        src = scratch_path(spark, "two-src")
        records.where(F.col("event_id") % 2 == part).write.parquet(src)
        stream = read_tick_stream(spark, fmt="parquet", path=src)
        start_tick_consumer(tick_stream(stream), sink, f"{sink}-{part}-ckpt", fmt="parquet").awaitTermination()
        clean_scratch(spark, src, f"{sink}-{part}-ckpt")
    return read_sink(spark, sink, schema=TICK_SINK_SCHEMA).drop("time", "batch_id", "run", "written_at")


def compaction_after_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1 SNK-3 AGG-2: stream bars of the first half of the ticks are compacted into the bar
    table, the sink expires, the second half is written by a new query to a new sink and
    compacted, twice: bars that have ticks in both halves have all of them, once."""
    ticks = fixtures.ticks(table(spark, sf_dir, "events")).drop("user_id")
    lo, hi = ticks.agg(F.min("ts"), F.max("ts")).first()
    # The halves meet in the middle of a bar.
    middle = (lo + (hi - lo) / 2).replace(minute=30, second=0, microsecond=0)
    table_path = scratch_path(spark, "compacted")
    for part in (ticks.where(F.col("ts") < F.lit(middle)), ticks.where(F.col("ts") >= F.lit(middle))):
        src, sink = scratch_path(spark, "half-src"), scratch_path(spark, "half-sink")
        part.write.parquet(src)
        bars = ohlcv_stream(spark.readStream.schema(ticks.schema).parquet(src), "1 hour", "1 hour", tiebreak="event_id")
        start_bar_upserts(bars, sink, f"{sink}-ckpt").awaitTermination()
        for _ in range(2):
            compact_bar_sink(spark, sink, table_path, "hourly")
        clean_scratch(spark, src, sink, f"{sink}-ckpt")
    stored = read_bar_table(spark, table_path).drop("ingest_seq", "year", "parts")
    return _cents(stored, "volumeto")


def collection_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2: bars appended to one document collection request by request number, even ones
    first; the collection read back."""
    payloads = fixtures.bar_payloads(table(spark, sf_dir, "events"))
    docs = scratch_path(spark, "collection")
    for rest in range(2):
        part = accept(parse_payloads(payloads.where(F.col("chunk_no") % 2 == rest)))
        write_documents(apply_transforms(part, BAR_TRANSFORMS), docs)
    return spark.read.schema(BAR_ROW_SCHEMA).json(docs)


def nested_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-4 FN-16 FN-6: per event kind its events, which dotted paths the frame has, and
    whether today in Seoul is today or tomorrow by UTC."""
    ev = table(spark, sf_dir, "events")
    parsed = ev.select("event_type", F.struct("value", F.from_json("props", "k int").alias("p")).alias("e"))
    paths = {"has_k": "e.p.k", "has_p": "e.p", "has_text": "e.p.k.x", "has_value_k": "e.value.k", "has_q": "q"}
    ahead = F.datediff(today_kst(), F.to_date(F.current_timestamp()))
    return parsed.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select(
        "*", *[F.lit(has_nested_column(parsed, path)).alias(c) for c, path in paths.items()],
        ahead.between(0, 1).alias("seoul_ahead"),
    )


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1: hourly bars in three increments. The first brings a trade count as INT; the
    second, the later half, has INT highs, BIGINT counts and two new columns; the third corrects
    the first half's ``view`` bars and has none of them. Every column and value stays."""
    bars = _hourly(spark, sf_dir).withColumn("batch_unit", F.lit("hourly"))
    early, late = (bars.where(F.col("time") < HALF), bars.where(F.col("time") >= HALF))
    path = scratch_path(spark, "evolving")
    seq = lambda n: F.lit(n).cast("long")
    merge_bars(early.withColumns({"ingest_seq": seq(1), "trades": F.col("volumefrom").cast("int")}), path)
    more = {
        "ingest_seq": seq(1),
        "high": F.floor("high").cast("int"),
        "trades": F.col("volumefrom").cast("long"),
        "spread": F.round(F.col("high") - F.col("low"), 2),
        "venue": F.struct(F.upper("symbol").alias("name")),
    }
    merge_bars(late.withColumns(more), path)
    fixed = early.where("symbol = 'view'").withColumns({"ingest_seq": seq(2), "close": F.col("close") + 1})
    merge_bars(fixed, path)
    return _cents(read_bar_table(spark, path), "volumeto").select(
        "time", "symbol", "high", "low", "open", "close", "volumefrom", "volumeto", "trades", "spread",
        F.col("venue.name").alias("venue"),
    )


def _landed(spark: SparkSession, payloads: DataFrame) -> str:
    raw = scratch_path(spark, "raw")
    land_payloads(payloads, raw)
    return raw


def bar_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6 SRC-1 SNK-1 SRC-2 API-8: payloads landed as JSON, many requests to a file, E1 to
    the partitioned bar table, the table read back for serving."""
    raw, bars = _landed(spark, fixtures.bar_payloads(table(spark, sf_dir, "events"))), scratch_path(spark, "bars")
    raw_to_bar_table(raw, bars).run(spark)
    clean_scratch(spark, raw)
    return read_bar_table(spark, bars).drop("ingest_seq", "year")


def incremental_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-6 SNK-1: requests land and are ingested in three increments (chunk number modulo
    3), the raw folder of each expiring before the next, the second increment twice:
    the table has every bar once."""
    payloads = fixtures.bar_payloads(table(spark, sf_dir, "events"))
    bars = scratch_path(spark, "bars")
    for part in range(3):
        raw = _landed(spark, payloads.where(F.col("chunk_no") % 3 == part))
        for _ in range(2 if part == 1 else 1):
            raw_to_bar_table(raw, bars).run(spark)
        clean_scratch(spark, raw)
    return read_bar_table(spark, bars).drop("ingest_seq", "year")


def quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT-1/3: E1 with a quarantine, run twice; one request in seven lands as garbage. The
    rejects read back, counted by what is wrong: none is lost or doubled."""
    payloads = fixtures.bar_payloads(table(spark, sf_dir, "events"), QUARANTINE_CHUNK)
    garbage = F.when(F.col("chunk_no") % 7 == 3, F.concat(F.lit("<html>"), F.col("symbol"))).otherwise(F.col("payload"))
    raw = _landed(spark, payloads.withColumn("payload", garbage))
    bars, bad = scratch_path(spark, "bars"), scratch_path(spark, "rejects")
    for _ in range(2):
        raw_to_bar_table(raw, bars, quarantine_root=bad).run(spark)
    kept = read_bar_table(spark, bars).select(F.lit("bar").alias("status"), "symbol")
    stored = read_quarantine(spark, bad).select("status", "symbol")
    clean_scratch(spark, raw)
    return kept.union(stored).groupBy("status", "symbol").agg(F.count(F.lit(1)).alias("n"))


def served_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-8 E1 then E2 (SNK-2), twice: payloads landed, bar table built, bar rows with
    their tier served to one JSON collection per symbol; the second run doubles nothing."""
    raw = _landed(spark, fixtures.bar_payloads(table(spark, sf_dir, "events")))
    bars, docs = scratch_path(spark, "bars"), scratch_path(spark, "docs")
    for _ in range(2):
        run_stages(spark, batch_stages(raw, bars, docs))
    clean_scratch(spark, raw, bars)
    return spark.read.schema(BAR_ROW_SCHEMA).json(docs)


def symbols_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5 SRC-2: bars of symbols that look like numbers (``007``: the user id modulo 10 in
    three digits), the table read for three of them by partition, symbols unchanged."""
    ticks = fixtures.ticks(table(spark, sf_dir, "events"))
    numbered = ticks.withColumn("symbol", F.lpad((F.col("user_id") % 10).cast("string"), 3, "0"))
    bars = ohlcv(numbered, "1 day", tiebreak="event_id")
    path = scratch_path(spark, "numbered")
    merge_bars(bars.withColumns({"batch_unit": F.lit("daily"), "ingest_seq": F.lit(1).cast("long")}), path)
    return _cents(read_symbols(spark, path, PRUNED_SYMBOLS).drop("ingest_seq", "year"), "volumeto")


def single_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ-4 FN-5: the bars of one symbol's payloads, the symbol added as a constant."""
    clicks = table(spark, sf_dir, "events").where(F.col("event_type") == ONE_SYMBOL)
    payloads = fixtures.bar_payloads(clicks).select("payload")
    return with_symbol(apply_transforms(accept(parse_payloads(payloads)), BAR_TRANSFORMS), ONE_SYMBOL)


def tick_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-5 SNK-4: ticks written as JSON records, decoded, routed to one collection per
    symbol, which is replaced by a second run, and read back."""
    ev = table(spark, sf_dir, "events")
    ticks = ev.select(F.col("event_type").alias("symbol"), F.col("value").alias("close"))
    records, by = scratch_path(spark, "records"), scratch_path(spark, "by-symbol")
    write_ticks(ticks, records, fmt="text")
    for _ in range(2):
        write_by_symbol(decode_ticks(spark.read.text(records)), by, mode="replace")
    clean_scratch(spark, records)
    return spark.read.schema("close double, symbol string").json(by).select("symbol", "close")


def coin_info_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16 PRJ-8: market-cap documents landed as JSON lines, read with the declared schema."""
    path = scratch_path(spark, "info")
    fixtures.coin_info(table(spark, sf_dir, "orders")).select("CoinInfo", "mktcap").write.json(path)
    return read_coin_info(spark, path).select(F.col("CoinInfo.Name").alias("name"), "mktcap")


def _pinned(fn: Query) -> Query:
    """Run a query with the session zone pinned to UTC (bar times, epochs and
    calendar text are defined in UTC), whatever session the caller built."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _pinned(fn) for name, fn in _registry().items()}


def _registry() -> dict[str, Query]:
    return {
        "bars_from_payload": bars_from_payload,
        "response_quarantine": response_quarantine,
        "ohlcv_1h": ohlcv_1h,
        "ohlcv_3h": ohlcv_3h,
        "bars_resample_1d": bars_resample_1d,
        "latest_price": latest_price_by_user,
        "latest_price_listed": latest_price_listed,
        "last_n_bars": last_n_bars_q,
        "quote_unpivot": quote_unpivot,
        "quote_quarantine": quote_quarantine,
        "symbol_dimension": symbol_dimension,
        "symbol_chunks": symbol_chunks,
        "kst_date": kst_date,
        "backfill_plan": backfill_plan_q,
        "remaining_backfill": remaining_backfill,
        "fill_schema": fill_schema,
        "tick_json_roundtrip": tick_json_roundtrip,
        "multiset_except": multiset_except,
        "tier_union": tier_union,
        "tier_select": tier_select,
        "tier_select_ranges": tier_select_ranges,
        "latest_price_as_of": latest_price_as_of,
        "last_n_bars_as_of": last_n_bars_as_of,
        "top_symbols": top_symbols,
        "calendar_functions": calendar_functions,
        "parse_dates": parse_dates,
        "parse_free_dates": parse_free_dates,
        "text_repair": text_repair,
        "nested_field_project": nested_field_project,
        "bars_dedupe": bars_dedupe,
        "bar_table_roundtrip": bar_table_roundtrip,
        "served_documents": served_documents,
        "incremental_landing": incremental_landing,
        "quarantine_roundtrip": quarantine_roundtrip,
        "symbols_pruned": symbols_pruned,
        "single_symbol": single_symbol,
        "tick_sink_roundtrip": tick_sink_roundtrip,
        "coin_info_table": coin_info_table,
        "sink_new_checkpoint": sink_new_checkpoint,
        "compaction_after_expiry": compaction_after_expiry,
        "schema_evolution": schema_evolution,
        "collection_append": collection_append,
        "nested_columns": nested_columns,
        "stream_ticks_parity": stream_ticks_parity,
        "stream_ohlcv_parity": stream_ohlcv_parity,
        "stream_dedupe_parity": stream_dedupe_parity,
        "stream_dedupe_expiry": stream_dedupe_expiry,
        "stream_quote_producer": stream_quote_producer,
        "stream_latest_price": stream_latest_price,
        "stream_enriched_ticks": stream_enriched_ticks,
        "stream_tick_quarantine": stream_tick_quarantine,
    }
