"""Writers. Every one is a single partitioned write: no per-key loops or jobs.

Writes that partition by ``symbol`` first ask for a REBALANCE on the
partition columns: adaptive execution then splits a hot symbol over several
tasks (and packs small ones together) instead of sending a third of the data
to one writer, which a plain ``repartition("symbol")`` would do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bars import combine_parts, dedupe_latest
from ..schemas import (
    BAR_TABLE_SCHEMA,
    ORDER_KEYS,
    PART_STRUCT,
    PARTITION_COLUMNS,
    PRICE_COLUMNS,
    QUARANTINE_SCHEMA,
    RAW_KEYS,
    TABLE_PARTITIONS,
)
from ..session import clean_scratch, has_children, scratch_path
from ..sources.files import read_bar_table
from .evolve import conform, evolve


def _rebalanced(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *cols) if cols else df


def _replace_partitions(df: DataFrame, path: str, fmt: str, cols: Sequence[str]) -> None:
    """Write the partitions that ``df`` has rows of, replacing just those."""
    (
        _rebalanced(df, cols)
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .save(path)
    )


def merge_bars(new: DataFrame, path: str) -> None:
    """SNK-1: merge bars into the one bar table for all symbols; nothing stored is lost.

    ``new`` has the bar columns, ``symbol``, ``batch_unit`` and ``ingest_seq``, and
    whatever other columns it brings: the table takes on new columns and wider types
    (:mod:`.evolve`), rows without a column have null there.

    **Whole bars.** Of bars with one ``(symbol, batch_unit, time)`` the latest ingested
    stays, so a rerun changes nothing and an increment adds.

    **Partial bars** have three more columns: ``part`` names who made them (a streaming
    query, a delivery), ``open_key`` and ``close_key`` give their first and last tick's place among
    all ticks (``ohlcv(..., order_keys=True)``). Parts of one bar are made of different ticks:
    they add up to one bar, and of one part's versions the latest ingested counts. So a part
    may come again, grown or not, before or after others. The table keeps a bar's parts in
    its column ``parts``, which scans for other columns do not read. Where there is a whole bar
    too, it shows, as its source has seen every tick.

    Only the ``(symbol, batch_unit, year)`` partitions that ``new`` touches are read and
    written again. The increment is written to the shared scratch folder once, so its plan
    runs once; the merged rows go straight into the table's staging folder and replace the
    old files when all are written.
    """
    spark = new.sparkSession
    rows = _with_parts(new).withColumn("year", F.substring("time", 1, 4))
    schema = evolve(spark, path, rows.schema, BAR_TABLE_SCHEMA)
    incoming = scratch_path(spark, "incoming")
    conform(rows, schema).write.parquet(incoming)
    rows = spark.read.schema(schema).parquet(incoming)
    if has_children(spark, path, f"{TABLE_PARTITIONS[0]}="):
        touched = rows.select(*TABLE_PARTITIONS).distinct()
        # The join prunes the table's partitions to the touched ones at run time.
        stored = read_bar_table(spark, path).join(touched, TABLE_PARTITIONS, "left_semi")
        rows = rows.unionByName(stored.select(*rows.columns))
    keys = (*PARTITION_COLUMNS, "year", "time")
    merged = combine_parts(rows, keys) if "parts" in schema.names else dedupe_latest(rows, keys=keys, keep_order=True)
    _replace_partitions(merged.select(*schema.names), path, "parquet", TABLE_PARTITIONS)
    clean_scratch(spark, incoming)


def _with_parts(new: DataFrame) -> DataFrame:
    """The columns of a partial bar as its one entry in ``parts``."""
    if "part" not in new.columns:
        return new
    values = {"part": F.col("part"), "seq": F.col("ingest_seq"), **{c: F.col(c) for c in (*ORDER_KEYS, *PRICE_COLUMNS)}}
    entry = F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in PART_STRUCT])
    return new.withColumn("parts", F.when(F.col("part").isNotNull(), F.array(entry))).drop("part", *ORDER_KEYS)


def write_documents(
    df: DataFrame,
    path: str,
    fmt: str = "json",
    mode: str = "append",
    options: Mapping[str, str] | None = None,
) -> None:
    """SNK-2: append a frame to a document collection (JSON lines by default).

    ``fmt``/``options`` select another connector, e.g. a document store's
    ``uri``/``database``/``collection`` when its jar is on the classpath.
    """
    w = df.write.format(fmt).mode(mode)
    for key, value in (options or {}).items():
        w = w.option(key, value)
    w.save(path)


def write_by_symbol(
    df: DataFrame, path: str, fmt: str = "json", mode: str = "append", options: Mapping[str, str] | None = None
) -> None:
    """SNK-3/4 + PRJ-7: route rows to one collection per symbol in one write.

    ``symbol`` moves from the row into the folder name. ``mode="replace"`` replaces
    the collections of the symbols that ``df`` has, so a rerun does not double them;
    the others stay.
    """
    w = _rebalanced(df, ["symbol"]).write.format(fmt).partitionBy("symbol")
    if mode == "replace":
        mode, w = "overwrite", w.option("partitionOverwriteMode", "dynamic")
    for key, value in (options or {}).items():
        w = w.option(key, value)
    w.mode(mode).save(path)


def batch_writer_by_symbol(
    path: str, fmt: str = "json", options: Mapping[str, str] | None = None, by: Sequence[str] = ("symbol",)
) -> Callable[[DataFrame, int], None]:
    """SNK-3: a ``foreachBatch`` function writing each micro-batch once.

    Output goes to ``path/symbol=<s>/run=<query>/batch_id=<id>`` with dynamic
    partition overwrite: a replayed batch replaces its own partitions instead of
    duplicating rows, and a query with another checkpoint (another id) never touches
    an earlier one's. ``written_at`` (microseconds) says when. Rows are
    rebalanced by symbol, so a batch has about one file per symbol. The batch is written
    with a single action: no emptiness probe re-runs its plan (an empty batch simply
    writes no partition, AGG-1). ``by``: other columns to route by.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The stream thread carries its query's id, which the checkpoint keeps.
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        keyed = batch.withColumns(
            {
                "run": F.lit(run),
                "batch_id": F.lit(batch_id).cast("long"),
                "written_at": F.unix_micros(F.current_timestamp()),
            }
        )
        w = (
            _rebalanced(keyed, by)
            .write.format(fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by, "run", "batch_id")
        )
        for key, value in (options or {}).items():
            w = w.option(key, value)
        w.save(path)

    return write_batch


def batch_writer(
    path: str, fmt: str = "parquet", by: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> Callable[[DataFrame, int], None]:
    """The same with a folder per query and batch, or by whatever columns ``by`` names."""
    return batch_writer_by_symbol(path, fmt, options, by)


def write_ticks(
    df: DataFrame,
    path: str | None = None,
    fmt: str = "kafka",
    topic: str = "ticks",
    options: Mapping[str, str] | None = None,
) -> None:
    """SNK-5: ticks as JSON records ``{"symbol", "close"}`` in a ``value`` column.

    Kafka gets ``acks=0`` and gzip as producer options; any text sink takes
    the same ``value`` column.
    """
    w = tick_records(df).write.format(fmt)
    if fmt == "kafka":
        w = w.option("topic", topic).option("kafka.acks", "0").option(
            "kafka.compression.type", "gzip"
        )
    else:
        w = w.mode("append")
    for key, value in (options or {}).items():
        w = w.option(key, value)
    w.save(path) if path else w.save()


def tick_records(df: DataFrame) -> DataFrame:
    """Ticks as ``value`` JSON, on batches and streams alike."""
    return df.select(F.to_json(F.struct("symbol", "close")).alias("value"))


def land_payloads(
    df: DataFrame, root: str, column: str = "payload", request: str = "chunk_no", delivery: str | None = None
) -> None:
    """SNK-6: land raw JSON text under ``root/delivery=/symbol=/batch_unit=``, many requests to
    a file; ``request`` names the column with a request's key.

    A delivery is a folder of its own, so collectors may land side by side; one that is landed
    again by its name replaces itself (by default each call is a new one). Of a request that
    several deliveries have, readers see the latest (:func:`~ohlcflow.sources.read_raw`): it
    is replaced without listing or rewriting its neighbours. Non-ASCII text is kept.
    """
    rows = df.select(F.col(request).cast("string").alias("request"), F.col(column).alias("payload"), *PARTITION_COLUMNS)
    path = f"{root}/delivery={delivery or uuid.uuid4().hex}"
    # The whole folder goes, also the series that the delivery no longer has.
    w = _rebalanced(rows, PARTITION_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "static")
    w.partitionBy(*PARTITION_COLUMNS).parquet(path)


def write_quarantine(df: DataFrame, root: str) -> None:
    """FLT-1: rejected documents, whole, under ``root/status=``; those of a delivery that is
    there already (a request and its landing time) are not written again."""
    spark = df.sparkSession
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in QUARANTINE_SCHEMA])
    if has_children(spark, root, "status="):
        known = [*RAW_KEYS, "ingest_seq"]
        stored = spark.read.schema(QUARANTINE_SCHEMA).parquet(root).select(*known)
        same = [rows[c].eqNullSafe(stored[c]) for c in known]
        rows = rows.join(stored, same, "left_anti")
    _rebalanced(rows, ["status"]).write.mode("append").partitionBy("status").parquet(root)
