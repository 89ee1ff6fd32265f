"""Streaming tick jobs.

The transforms are the batch ones (``DataFrame.transform`` chains); only the
source, the trigger and the sink differ. Every query has a checkpoint, so a
restart resumes from the stored offsets (quirk Q8) and a rerun adds nothing.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DecimalType, DoubleType, LongType, StringType, StructField, StructType

from ..jobs import Transform, apply_transforms
from ..operators.bars import dedupe_latest, merge_partial_bars, ohlcv
from ..operators.ticks import TICK_TRANSFORMS, add_ingest_time, check_ticks, fill_bar_schema, unpivot_quotes
from ..schemas import ORDER_KEYS, PRICE_COLUMNS, SERVED_COLUMNS
from ..session import has_children, path_exists
from ..sinks.writers import batch_writer_by_symbol, merge_bars, tick_records


def tick_stream(records: DataFrame) -> DataFrame:
    """STR-1: binary records to served tick rows (same chain as batch)."""
    return apply_transforms(records, TICK_TRANSFORMS)


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_writing(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = "availableNow",
    output_mode: str = "append",
    query_name: str | None = None,
    enrichments: Sequence[Transform] = (),
) -> StreamingQuery:
    """A query that hands each micro-batch, enriched, to ``write``.

    ``enrichments`` (API-4) are applied to the micro-batch as a batch frame, so what they read
    (a dimension, say) is read anew for every batch, and they may use what streams cannot."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write(apply_transforms(batch, enrichments), batch_id)

    w = rows.writeStream.outputMode(output_mode).foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()


def start_tick_consumer(
    ticks: DataFrame,
    sink_path: str,
    checkpoint: str,
    fmt: str = "json",
    trigger: str | None = "availableNow",
    query_name: str | None = None,
    options: Mapping[str, str] | None = None,
    enrichments: Sequence[Transform] = (),
    by: Sequence[str] = ("symbol",),
) -> StreamingQuery:
    """STR-2/4 + SNK-3: write each micro-batch once, routed by symbol.

    ``trigger`` is ``"availableNow"`` (drain and stop) or a processing-time
    interval such as ``"10 seconds"``. ``enrichments``: see :func:`start_writing`.
    """
    write = batch_writer_by_symbol(sink_path, fmt, options, by)
    return start_writing(ticks, write, checkpoint, trigger, "append", query_name, enrichments)


#: How a record of the quarantine's stream is kept: the served columns, what is wrong, and the text.
CHECKED_SCHEMA = StructType(
    [StructField(c, StringType() if c in ("time", "symbol") else DoubleType()) for c in SERVED_COLUMNS]
    + [StructField("payload", StringType()), StructField("status", StringType())]
)


def checked_tick_stream(records: DataFrame) -> DataFrame:
    """STR-1 with FLT-1/FLT-3: every record once, as a served tick (``status`` ``ok``) or as a
    reject with its whole text (:func:`~ohlcflow.operators.ticks.check_ticks`)."""
    return apply_transforms(records, (check_ticks, add_ingest_time, fill_bar_schema))


def start_checked_consumer(
    records: DataFrame,
    sink_path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: str | None = "availableNow",
    enrichments: Sequence[Transform] = (),
) -> StreamingQuery:
    """STR-2 with a quarantine: ticks under ``status=ok/symbol=``, rejects under ``status=<what is
    wrong>``, both of a micro-batch in one write: the batch is decoded once, and a batch that is
    replayed replaces its part of both. :func:`read_checked` reads either."""
    checked = checked_tick_stream(records)
    return start_tick_consumer(checked, sink_path, checkpoint, fmt, trigger, None, None, enrichments, ("status", "symbol"))


def read_checked(spark: SparkSession, sink_path: str, fmt: str = "parquet", rejects: bool = False) -> DataFrame:
    """The served ticks of a checked sink, or its ``rejects``."""
    schema = _sink_schema(CHECKED_SCHEMA.fields)
    if not has_children(spark, sink_path, "status="):
        rows = spark.createDataFrame([], schema)
    else:
        rows = spark.read.format(fmt).schema(schema).load(sink_path)
    good = F.col("status") == "ok"
    return rows.where(~good) if rejects else rows.where(good).drop("payload", "status")


def start_quote_producer(
    spark: SparkSession,
    quotes_path: str,
    out_path: str,
    checkpoint: str,
    fmt: str = "json",
    trigger: str | None = "10 seconds",
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """STR-3 + SNK-5: landed quote documents (text files) to tick records.

    Each new file is unpivoted (GEN-2) and published as ``{"symbol","close"}``
    JSON in a ``value`` column; with ``fmt="kafka"`` pass the broker and topic
    in ``options``.
    """
    quotes = spark.readStream.format("text").load(quotes_path).withColumnRenamed("value", "payload")
    w = tick_records(unpivot_quotes(quotes)).writeStream.format(fmt).option("checkpointLocation", checkpoint)
    for key, value in (options or {}).items():
        w = w.option(key, value)
    w = _trigger(w, trigger)
    return w.start() if fmt == "kafka" else w.start(out_path)


def ohlcv_stream(
    ticks: DataFrame,
    every: str,
    watermark: str,
    ts: str = "ts",
    price: str = "price",
    keys: Sequence[str] = ("symbol",),
    tiebreak: str | None = None,
) -> DataFrame:
    """AGG-2 on a stream: the batch OHLCV with a watermark bounding the state.

    ``withWatermark`` needs TIMESTAMP, so a TIMESTAMP_NTZ event time is cast
    first (session zone UTC). Append mode emits a bar once the watermark
    passes its end. Ticks behind the watermark are dropped, also those that come for
    the first time; :func:`dropped_as_late` tells how many. Bars carry the places of their
    open and close, so those of several queries can be put together.
    """
    t = ticks.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return ohlcv(t, every, ts=ts, price=price, keys=keys, tiebreak=tiebreak, order_keys=True)


def start_bar_upserts(
    bars: DataFrame,
    sink_path: str,
    checkpoint: str,
    trigger: str | None = "availableNow",
    fmt: str = "parquet",
    query_name: str | None = None,
    output_mode: str = "update",
) -> StreamingQuery:
    """Streaming bars written per micro-batch, keyed by query and batch.

    ``update`` (default): each batch writes the bars it changed, so no bar
    waits for the watermark to be visible, and :func:`read_latest_bars` keeps
    the newest version. ``append``: each bar is written once, final, after the
    watermark has passed its end (the production choice when consumers must
    never see a bar change). State is bounded by the watermark of
    :func:`ohlcv_stream` either way.
    """
    if output_mode not in ("update", "append"):
        raise ValueError(f"unsupported output mode {output_mode!r}")
    return start_writing(bars, batch_writer_by_symbol(sink_path, fmt), checkpoint, trigger, output_mode, query_name)


#: What :func:`~ohlcflow.sinks.batch_writer_by_symbol` adds to a row.
_VERSION = [
    StructField("written_at", LongType()),
    StructField("symbol", StringType()),
    StructField("run", StringType()),
    StructField("batch_id", LongType()),
]


def _sink_schema(columns: Sequence[StructField]) -> StructType:
    names = {f.name for f in _VERSION}
    return StructType([f for f in columns if f.name not in names] + _VERSION)


#: Sinks of ticks (the served columns) and of bars that carry their order keys.
TICK_SINK_SCHEMA = _sink_schema([StructField(c, StringType() if c == "time" else DoubleType()) for c in SERVED_COLUMNS])
BAR_SINK_SCHEMA = _sink_schema(
    [StructField("time", StringType())]
    + [StructField(c, DoubleType()) for c in PRICE_COLUMNS]
    + [StructField(c, DecimalType(38, 0)) for c in ORDER_KEYS]
)


def read_sink(spark: SparkSession, sink_path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """All rows of a sink of :func:`batch_writer_by_symbol`; symbols and query ids stay text.

    Pass the sink's ``schema`` (``TICK_SINK_SCHEMA``, ``BAR_SINK_SCHEMA``) where it is known:
    else it is found by looking into files, which for JSON means all of them. A declared
    sink that has no batch yet has no rows."""
    if schema is None:
        found = spark.read.format(fmt).load(sink_path).schema
        text = [StructField(f.name, StringType()) if f.name in ("symbol", "run") else f for f in found]
        schema = StructType(text)
    elif not has_children(spark, sink_path, "symbol="):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(sink_path)


def _latest_parts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of every query's versions of a bar the one of its last micro-batch. Batches are
    numbered by the query, so no clock has a say."""
    return dedupe_latest(rows.drop("written_at"), keys=(*keys, "run"), order_col="batch_id", keep_order=True)


def read_latest_bars(
    spark: SparkSession,
    sink_path: str,
    keys: Sequence[str] = ("symbol", "time"),
    fmt: str = "parquet",
) -> DataFrame:
    """The bars that queries with :func:`start_bar_upserts` have written: every query's last
    version of a bar, and where several queries (checkpoints) have seen different ticks of one
    bar, those put together."""
    schema = BAR_SINK_SCHEMA if tuple(keys) == ("symbol", "time") else None
    parts = _latest_parts(read_sink(spark, sink_path, fmt, schema), keys)
    return merge_partial_bars(parts, keys).select(*keys, *PRICE_COLUMNS)


def dedupe_stream(records: DataFrame, keys: Sequence[str], ts: str, watermark: str) -> DataFrame:
    """Drop repeated records (at-least-once producers, several consumers of
    one topic, quirk Q15) with state bounded by a watermark on ``ts``.

    ``dropDuplicatesWithinWatermark`` keeps the first record per key and
    forgets a key once the watermark passes it, so copies arriving within
    ``watermark`` of each other are removed. A record behind the watermark is
    dropped even if it comes for the first time: choose the watermark by the longest
    delay that must not lose data, and watch :func:`dropped_as_late`.
    """
    t = records.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    return t.dropDuplicatesWithinWatermark(list(keys))


def dropped_as_late(query: StreamingQuery) -> int:
    """Rows that a query's stateful operators dropped behind the watermark, over the
    micro-batches that its recent progress covers."""
    return sum(
        int(op["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for op in json.loads(progress.json if hasattr(progress, "json") else json.dumps(progress))["stateOperators"]
    )


def compact_bar_sink(
    spark: SparkSession, sink_path: str, table_path: str, batch_unit: str, part: str | None = None
) -> None:
    """Merge the per-batch output of :func:`start_bar_upserts` into the bar table, tagged with
    ``batch_unit``: every query's last version of a bar as that query's part of it.

    The table puts the parts of a bar together, so a bar whose ticks came in two query runs
    (a new checkpoint, a sink that expired in between) has all of them. Sink folders may
    expire by age once they were compacted, and compacting again (whatever is left of the
    sink) loses and doubles nothing. A query that reads the same ticks again under a new
    checkpoint must replace its earlier self: give both one ``part`` name. A sink that has
    no batch yet adds nothing."""
    rows = read_sink(spark, sink_path, schema=BAR_SINK_SCHEMA)
    if rows.isEmpty():
        return
    latest = _latest_parts(rows, ("symbol", "time")).withColumnRenamed("batch_id", "ingest_seq")
    name = F.col("run") if part is None else F.lit(part)
    merge_bars(latest.withColumns({"part": name, "batch_unit": F.lit(batch_unit)}).drop("run"), table_path)


def compact_tick_sink(spark: SparkSession, sink_path: str, table_path: str, fmt: str = "parquet") -> None:
    """Fold the many small folders of a tick sink into one table by symbol.

    Ticks have no key, so a whole ``(symbol, run, batch_id)`` is copied once: folders the
    table has already are skipped, and rows of the table are never written again. A sink
    that has no batch yet adds nothing."""
    rows = read_sink(spark, sink_path, fmt, TICK_SINK_SCHEMA)
    if rows.isEmpty():
        return
    parts = ["symbol", "run", "batch_id"]
    if path_exists(spark, table_path):
        done = read_sink(spark, table_path, schema=TICK_SINK_SCHEMA).select(*parts).distinct()
        same = [rows[c].eqNullSafe(done[c]) for c in parts]
        rows = rows.join(done, same, "left_anti")
    rows.hint("rebalance", "symbol").write.mode("append").partitionBy("symbol").parquet(table_path)
