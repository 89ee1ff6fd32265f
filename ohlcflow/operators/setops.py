"""Set operations (SET-1; SET-2 re-aimed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Copies of one row produced by one generator step; larger counts are split
# into blocks that are spread over tasks before they are expanded.
REPLICA_BLOCK = 10_000


def except_all(left: DataFrame, right: DataFrame, block: int = REPLICA_BLOCK) -> DataFrame:
    """SET-1: multiset difference (``EXCEPT ALL``): every row of ``left`` kept
    ``max(count_left - count_right, 0)`` times. Nulls compare equal.

    A signed count per distinct row is aggregated with a map-side partial
    step (duplicates collapse before the shuffle), and a row's copies are made
    where its count lies. Only a row with more than ``block`` copies moves again:
    its copies are cut into blocks that are spread over the session's shuffle
    partitions before they are expanded, so that no task emits a row that makes
    up a third of the input alone. Both kinds read the one exchange.
    """
    cols = left.columns
    signed = left.select(*cols, F.lit(1).alias("_sign")).unionByName(
        right.select(*cols, F.lit(-1).alias("_sign"))
    )
    net = signed.groupBy(*cols).agg(F.sum("_sign").alias("_n")).where(F.col("_n") > 0)

    def copies(df: DataFrame, n: Column) -> DataFrame:
        return df.select(*cols, F.explode(F.array_repeat(F.lit(0), n.cast("int"))).alias("_r")).drop("_r")

    few = copies(net.where(F.col("_n") <= block), F.col("_n"))
    numbers = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / block).cast("long"))
    blocks = net.where(F.col("_n") > block).select(*cols, "_n", F.explode(numbers).alias("_b"))
    # An explicit partition count: block rows are tiny in bytes, and adaptive
    # coalescing would otherwise pack a hot row's blocks back into one task.
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.least(F.lit(block).cast("long"), F.col("_n") - F.col("_b") * block)
    return few.union(copies(blocks.repartition(n, *cols, "_b"), size))


def new_rows(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of ``incoming`` not already in ``existing`` (as multisets).

    Splitting a frame into single-row frames (SET-2) is not reproduced: rows
    are routed by key in one partitioned write
    (:func:`ohlcflow.sinks.write_by_symbol`).
    """
    return except_all(incoming, existing)
