"""Enrichments (API-4): transforms bound to arguments, for ``Job.enrichments`` and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_dimension(
    df: DataFrame, path: str, columns: Sequence[str], key: str = "symbol", fmt: str = "parquet"
) -> DataFrame:
    """``df`` with ``columns`` of the dimension stored at ``path``, null where it does not
    know the key. No row of ``df`` is lost or doubled: of rows that a dimension has twice for a
    key one is taken, the greatest.

    The table is read when this is called. Bound into a batch job that is once a run; bound into a
    stream's enrichments it is once a micro-batch, so a batch sees the dimension as it is then.
    Whether it is broadcast or shuffled is Catalyst's choice by its size."""
    taken = set(columns) & set(df.columns)
    if taken:
        raise ValueError(f"columns that the frame has already: {sorted(taken)}")
    dim = df.sparkSession.read.format(fmt).load(path).where(F.col(key).isNotNull())
    one = dim.groupBy(key).agg(F.max(F.struct(*columns)).alias("_one"))
    return df.join(one, key, "left").select(*df.columns, *[F.col(f"_one.{c}").alias(c) for c in columns])
