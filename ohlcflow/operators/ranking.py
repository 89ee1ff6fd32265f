"""Positions, chunks and top-N (WIN-1, AGG-4, TOP-1, LIM-1, F7).

Global positions are computed without a single-partition window: the frame is
range-partitioned on a total order and checkpointed (so every pass sees the
same partitions, and lineage is cut in the shared checkpoint folder), then
per-partition counts - one number per partition - give each partition its
offset, added to the row's position inside its partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def row_index(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str = "row_idx",
    num_partitions: int | None = None,
) -> DataFrame:
    """1-based position of every row under ``order``, which must be total.

    Work is spread over ``num_partitions`` range partitions (default: the
    session's shuffle partitions). Only the per-partition counts reach the
    driver; the offsets go back as a frame of one row per partition, and
    ``monotonically_increasing_id`` (partition index and position within the
    partition) completes the number - JVM-side, no Python worker.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = _order_cols(order)
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).checkpoint(eager=True)
    parts = ranged.rdd.getNumPartitions()
    counts = ranged.groupBy(F.spark_partition_id().alias("pid")).count().collect()
    sizes = {int(r["pid"]): int(r["count"]) for r in counts}
    offsets, acc = [], 0
    for pid in range(parts):
        offsets.append((pid, acc))
        acc += sizes.get(pid, 0)
    # One row per partition, joined by partition number.
    before = spark.createDataFrame(offsets, "_pid int, _before long")
    mid = F.monotonically_increasing_id()
    numbered = ranged.withColumns(
        {"_pid": F.shiftright(mid, 33).cast("int"), "_at": mid.bitwiseAND(F.lit((1 << 33) - 1))}
    )
    position = (F.col("_before") + F.col("_at") + 1).cast("long").alias(name)
    return numbered.join(F.broadcast(before), "_pid").select(*df.columns, position)


def rank_symbols(
    totals: DataFrame, value: str = "total", key: str = "symbol", name: str = "rank"
) -> DataFrame:
    """``(rank, symbol)`` by ``value`` descending, ties by key ascending."""
    ranked = row_index(totals, [F.col(value).desc(), F.col(key).asc()], name=name)
    # LONG: a symbol dimension can outgrow 2^31 rows.
    return ranked.select(F.col(name).alias(name), *[c for c in totals.columns])


def chunk_no(rank: str | Column, size: int) -> Column:
    """WIN-1: positional chunk of a 1-based rank: ``floor((rank-1)/size)``."""
    r = F.col(rank) if isinstance(rank, str) else rank
    return F.floor((r - 1) / F.lit(size)).cast("long")


def chunk_symbols(
    ranked: DataFrame, size: int, rank: str = "rank", symbol: str = "symbol", sep: str = ","
) -> DataFrame:
    """WIN-1 + AGG-4: ``(chunk_no, symbols, n_symbols)``, symbols joined in rank order.

    Every group holds at most ``size`` rows, so collecting it is bounded.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(symbol).alias("s"))))
    return ranked.groupBy(chunk_no(rank, size).alias("chunk_no")).agg(
        F.array_join(F.transform(pairs, lambda x: x["s"]), sep).alias("symbols"),
        F.count(F.lit(1)).cast("int").alias("n_symbols"),
    )


def top_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """TOP-1 / LIM-1: the first ``n`` rows under ``order`` (TakeOrderedAndProject).

    Each task keeps ``n`` rows, so the final merge is bounded by ``n`` times
    the task count. ``order`` should be total for a deterministic result.
    """
    return df.orderBy(*_order_cols(order)).limit(n)
