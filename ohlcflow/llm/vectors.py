"""Vector columns: which rows hold usable vectors, and their matrices inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors of a block of numpy work.
BLOCK_ROWS = 8192


def usable_vectors(df: DataFrame, vector: str, *keep: str) -> tuple[DataFrame, int]:
    """``(rows, dimension)``: the ``keep`` columns and the vector of the rows whose vector is
    neither null nor empty and holds neither null nor non-finite entries. One matrix needs
    one dimension: the commonest length (of equally common ones the greater); vectors of
    other lengths are left out, as no product with them is defined. 0 if there is none."""
    kind = df.schema[vector].dataType.elementType.typeName()
    v = F.col(vector) if kind in ("float", "double") else F.col(vector).cast("array<double>")
    rows = df.select(*keep, v.alias(vector))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col(vector).isNotNull() & ~bad & (F.size(vector) > 0))
    common = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = common["d"] if common else 0
    return rows.where(F.size(vector) == dim), dim


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of an Arrow list column, all of one dimension, as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def matrix_blocks(batch: pa.RecordBatch, vector: str, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of at most ``BLOCK_ROWS`` rows with their matrices."""
    for i in range(0, batch.num_rows, BLOCK_ROWS):
        part = batch.slice(i, BLOCK_ROWS)
        yield part, matrix(part.column(part.schema.get_field_index(vector)), dim)
