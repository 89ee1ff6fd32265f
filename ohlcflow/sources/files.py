"""Batch sources: raw payload folders and the bar table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import has_children, scratch_path, table_columns
from ..schemas import (
    BAR_TABLE_SCHEMA,
    COIN_INFO_SCHEMA,
    PAYLOAD_SCHEMA,
    QUARANTINE_SCHEMA,
    RAW_KEYS,
    RAW_SCHEMA,
    TABLE_PARTITIONS,
)

#: Superseded deliveries up to which their list is broadcast (three short texts and a time).
BROADCAST_ROWS = 1_000_000

_FOLDER_SCHEMA = StructType([StructField("payload", StringType()), *[StructField(c, StringType()) for c in RAW_KEYS]])


def read_raw(spark: SparkSession, root: str, layout: str = "packed") -> DataFrame:
    """SRC-1: every landed document as it is: ``symbol``, ``batch_unit``, ``request``,
    ``payload`` and ``ingest_seq``, the time its file landed in microseconds of the store's
    clock (a later delivery of the same bars has a larger one). A root where nothing has
    landed yet has no rows.

    ``packed``: what :func:`~ohlcflow.sinks.land_payloads` lands; of a request's deliveries
    only the latest. ``folders``: one text file per request under
    ``root/symbol=/batch_unit=/request=``, as other collectors land them.
    """
    columns = [*RAW_KEYS, "payload"]
    landed = F.unix_micros("_metadata.file_modification_time").alias("ingest_seq")
    if layout not in ("packed", "folders"):
        raise ValueError(f"unknown layout {layout!r}")
    if not has_children(spark, root, "delivery=" if layout == "packed" else "symbol="):
        none = spark.createDataFrame([], RAW_SCHEMA).select(*columns)
        return none.withColumn("ingest_seq", F.lit(0).cast("long"))
    if layout == "folders":
        return spark.read.schema(_FOLDER_SCHEMA).text(root).select(*columns, landed)
    rows = spark.read.schema(RAW_SCHEMA).parquet(root).select(*columns, landed)
    # From keys and file times alone: the requests that landed more than once. They are
    # written down, so that their size is known before the documents are joined with them.
    several = rows.groupBy(*RAW_KEYS).agg(
        F.max("ingest_seq").alias("latest"), F.min("ingest_seq").alias("oldest")
    )
    several = several.where("latest > oldest").drop("oldest")
    path = scratch_path(spark, "superseded")
    several.write.parquet(path)
    several = spark.read.schema(several.schema).parquet(path)
    n = several.count()
    if n == 0:
        return rows
    several = F.broadcast(several) if n <= BROADCAST_ROWS else several
    latest = several.select(*[F.col(c).alias(f"_{c}") for c in RAW_KEYS], "latest")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in RAW_KEYS]
    return rows.join(latest, same, "left").where("latest IS NULL OR ingest_seq = latest").select(*columns, "ingest_seq")


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """FLT-1: the rejected documents stored so far; no rows where there are none."""
    if not has_children(spark, root, "status="):
        return spark.createDataFrame([], QUARANTINE_SCHEMA)
    return spark.read.schema(QUARANTINE_SCHEMA).parquet(root)


def parse_payloads(df: DataFrame, column: str = "payload") -> DataFrame:
    """SRC-1 on text already in a frame: ``from_json`` with the payload schema, plus
    ``malformed`` where the text is no such document."""
    carry = [c for c in df.columns if c != column]
    p = F.from_json(F.col(column), StructType([*PAYLOAD_SCHEMA.fields, _CORRUPT]), {"columnNameOfCorruptRecord": "_bad"})
    parsed = df.select(*carry, p.alias("_p"))
    bad = F.col("_p").isNull() | F.col("_p._bad").isNotNull()
    return parsed.select(*carry, *[F.col(f"_p.{f}") for f in PAYLOAD_SCHEMA.names], bad.alias("malformed"))


_CORRUPT = StructField("_bad", StringType())


def read_payloads(spark: SparkSession, root: str, layout: str = "packed") -> DataFrame:
    """SRC-1: the landed documents parsed with the declared schema (nothing inferred)."""
    return parse_payloads(read_raw(spark, root, layout))


def read_coin_info(spark: SparkSession, path: str) -> DataFrame:
    """Market-cap info documents (F8, quirk Q16): a JSON array or JSON lines
    of ``{"CoinInfo": {"Name": ...}, "mktcap": ...}`` read by declared schema;
    a missing ``Name`` is null."""
    return spark.read.schema(COIN_INFO_SCHEMA).json(path)


def read_bar_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """SRC-2: the partitioned bar table with the columns it keeps (those of every bar table
    where it keeps none); partition values stay text (a symbol ``007`` is no number) and no
    footer is read to find the columns.

    ``merge_schema`` is for tables that other writers append to: it asks for schema evolution: the columns of all files, at the price of
    reading every footer; partition values stay text all the same.
    """
    reader = spark.read.format(fmt)
    if not merge_schema:
        return reader.schema(table_columns(spark, path) or BAR_TABLE_SCHEMA).load(path)
    found = spark.read.format(fmt).option("mergeSchema", "true").load(path).schema
    text = [StructField(f.name, StringType()) if f.name in TABLE_PARTITIONS else f for f in found]
    return reader.schema(StructType(text)).load(path)


def read_symbols(
    spark: SparkSession, path: str, symbols: Sequence[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """SRC-5: one partitioned scan for all symbols; a list prunes partitions."""
    df = read_bar_table(spark, path, fmt)
    return df if symbols is None else df.where(F.col("symbol").isin(list(symbols)))
