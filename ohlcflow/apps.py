"""The reference's three entry points as jobs (API-5..8).

E1 raw payloads -> bar table, E2 bar table -> serving collection, E3 tick
stream -> serving collection. Each is one Spark job for all symbols (no loop
over symbols) and may be run again: E1 merges by key, E2 replaces the
collections of the symbols it serves, E3 has a checkpoint plus output keyed by
query and batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .jobs import Job, Stage, run_stages
from .operators.bars import explode_payload, parse_bar_time, cast_prices
from .operators.quality import accept, classify
from .schemas import BAR_ROW_SCHEMA, SERVED_COLUMNS
from .sinks.writers import merge_bars, write_by_symbol, write_quarantine
from .sources.files import parse_payloads, read_bar_table, read_raw, read_symbols
from .sources.stream import read_tick_stream
from .streaming.ticks import start_tick_consumer, tick_stream


def _stored_columns(df: DataFrame) -> DataFrame:
    return df.select(*BAR_ROW_SCHEMA.names, "ingest_seq")


def raw_to_bar_table(
    raw_root: str, table_path: str, quarantine_root: str | None = None, layout: str = "packed"
) -> Job:
    """E1: accepted payloads of every symbol and tier, flattened, typed and merged into
    the one partitioned bar table (:func:`merge_bars`). Bars that overlapping requests
    returned twice are one, the later landed. With ``quarantine_root`` rejected and
    malformed documents are stored there, whole, by what is wrong with them. ``layout``:
    how documents have landed (:func:`~ohlcflow.sources.read_raw`).
    """

    def read(spark: SparkSession) -> DataFrame:
        raw = read_raw(spark, raw_root, layout)
        if quarantine_root is not None:
            write_quarantine(rejects(raw), quarantine_root)
        return accept(parse_payloads(raw))

    return Job(
        read=read,
        transforms=(explode_payload, parse_bar_time, cast_prices, _timed, _stored_columns),
        write=lambda df: merge_bars(df, table_path),
        name="raw_to_bar_table",
    )


def _timed(df: DataFrame) -> DataFrame:
    """Bars without a time have no place in the table."""
    return df.where(F.col("time").isNotNull())


def rejects(raw: DataFrame) -> DataFrame:
    """FLT-1/3: landed documents that are not accepted, whole, with their ``status``."""
    return classify(parse_payloads(raw.withColumn("_text", F.col("payload")))).where("status <> 'accepted'").select(
        *[c for c in raw.columns if c != "payload"], F.col("_text").alias("payload"), "status"
    )


def bar_table_to_documents(
    table_path: str,
    serve_path: str,
    symbols: Sequence[str] | None = None,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
) -> Job:
    """E2: bar rows with their tier to one serving collection per symbol, replacing those
    of the symbols served."""

    def read(spark: SparkSession) -> DataFrame:
        df = read_symbols(spark, table_path, symbols) if symbols else read_bar_table(spark, table_path)
        return df.select(*SERVED_COLUMNS, "batch_unit")

    return Job(
        read=read,
        write=lambda df: write_by_symbol(df, serve_path, fmt=fmt, mode="replace", options=options),
        name="bar_table_to_documents",
    )


def batch_stages(
    raw_root: str, table_path: str, serve_path: str, quarantine_root: str | None = None, layout: str = "packed"
) -> list[Job]:
    """API-8: the stage order after landing: bars, then serving."""
    bars = raw_to_bar_table(raw_root, table_path, quarantine_root, layout)
    return [bars, bar_table_to_documents(table_path, serve_path)]


def batch_graph(
    sources: Mapping[str, Callable[[SparkSession], None]],
    raw_root: str,
    table_path: str,
    serve_path: str,
    quarantine_root: str | None = None,
    layout: str = "packed",
) -> list[Stage]:
    """API-8: the whole batch for :func:`~ohlcflow.jobs.run_graph`: the tiers' collectors
    (``sources``, by name) side by side, then bars, then serving."""
    bars, serve = batch_stages(raw_root, table_path, serve_path, quarantine_root, layout)
    collect = [Stage(name, run) for name, run in sources.items()]
    return [
        *collect,
        Stage(bars.name, bars.run, after=tuple(sources)),
        Stage(serve.name, serve.run, after=(bars.name,)),
    ]


def run_batch(
    spark: SparkSession,
    raw_root: str,
    table_path: str,
    serve_path: str,
    quarantine_root: str | None = None,
    layout: str = "packed",
) -> None:
    run_stages(spark, batch_stages(raw_root, table_path, serve_path, quarantine_root, layout))


def start_tick_app(
    spark: SparkSession,
    sink_path: str,
    checkpoint: str,
    fmt: str = "kafka",
    source_path: str | None = None,
    trigger: str | None = "10 seconds",
    sink_fmt: str = "json",
    sink_options: Mapping[str, str] | None = None,
    **source_options: str,
):
    """E3: records -> tick chain -> one write per micro-batch routed by symbol.

    ``sink_fmt`` and ``sink_options`` select the sink's connector."""
    records = read_tick_stream(spark, fmt=fmt, path=source_path, **source_options)
    return start_tick_consumer(
        tick_stream(records), sink_path, checkpoint, fmt=sink_fmt, trigger=trigger, options=sink_options
    )
