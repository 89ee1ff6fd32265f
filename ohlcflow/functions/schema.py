"""FLT-4 / FN-16: does a dotted column path exist? Metadata only, no job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructType


def has_nested_column(df: DataFrame, path: str) -> bool:
    """True when every step of ``a.b.c`` names a field of a struct.

    A non-struct parent gives False (selecting ``x.*`` on it would raise).
    """
    if not path:
        return False
    current: DataType = df.schema
    for part in path.split("."):
        if not isinstance(current, StructType) or part not in current.fieldNames():
            return False
        current = current[part].dataType
    return True
