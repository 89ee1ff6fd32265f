"""Schema evolution on write (SNK-1): what a table's columns become when an increment comes.

A table keeps its columns and types as numbered JSON documents under ``_schema`` in its
folder (a name that no reader takes for data), so a reader declares them and opens no
footer. An increment may bring new columns, lack old ones, and have other types:

* columns are matched by name without regard to case, structs field by field; the result
  has the columns of both, older rows and rows without a column read as null;
* an increment whose type fits the table's is cast to it (``INT`` prices in a ``DOUBLE``
  column);
* a type that holds more widens the table's, where files written before can be read as the
  wider type as they are: integers to longer ones, to doubles (up to 32 bits) and to
  decimals, floats to doubles, decimals to longer ones, dates to times without zone;
* anything else (text in a number column, a double in a long column) would lose values and
  is refused with :class:`SchemaConflict`; nothing is written then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import SCHEMA_FOLDER, create_file, schema_versions, table_columns

_INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_ORDER = list(_INTEGERS)


class SchemaConflict(ValueError):
    """An increment whose column cannot be kept beside the table's without losing values."""


def _digits(t: T.DataType) -> tuple[int, int] | None:
    """Whole and fractional digits of an exact number type."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return (_INTEGERS[type(t)], 0) if type(t) in _INTEGERS else None


def _fits(new: T.DataType, old: T.DataType) -> bool:
    """Whether values of ``new`` are stored in a column of ``old`` as they are, or as the
    nearest double."""
    if isinstance(old, T.DoubleType):
        return isinstance(new, T.FloatType) or _digits(new) is not None
    if isinstance(old, T.TimestampNTZType):
        return isinstance(new, T.DateType)
    a, b = _digits(new), _digits(old)
    return a is not None and b is not None and a[0] <= b[0] and a[1] <= b[1]


def _widened(old: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type for both that files of ``old`` can be read as; None if there is none."""
    if isinstance(old, T.DateType) and isinstance(new, T.TimestampNTZType):
        return new
    short = type(old) in _ORDER[:3]
    if isinstance(new, (T.FloatType, T.DoubleType)) and (short or isinstance(old, T.FloatType)):
        return T.DoubleType()
    if type(old) in _ORDER and type(new) in _ORDER:
        return max(old, new, key=lambda t: _ORDER.index(type(t)))
    a, b = _digits(old), _digits(new)
    if a and b:
        whole, part = max(a[0], b[0]), max(a[1], b[1])
        return T.DecimalType(whole + part, part) if whole + part <= 38 else None
    return None


def common_type(old: T.DataType, new: T.DataType, name: str = "") -> T.DataType:
    """The type that a column of ``old`` has once values of ``new`` are added."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return common_schema(old, new, f"{name}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(common_type(old.elementType, new.elementType, f"{name}[]"))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, common_type(old.valueType, new.valueType, f"{name}[]"))
    if _fits(new, old):
        return old
    wide = _widened(old, new)
    if wide is None:
        raise SchemaConflict(f"column {name}: {new.simpleString()} cannot be added to {old.simpleString()}")
    return wide


def common_schema(old: T.StructType, new: T.StructType, prefix: str = "") -> T.StructType:
    """The columns of both: the table's in its order, then the new ones."""
    found = {f.name.lower(): f for f in new.fields}
    if len(found) < len(new.fields):
        raise SchemaConflict(f"columns that differ only in case: {new.fieldNames()}")
    known = {f.name.lower() for f in old.fields}
    out = [
        T.StructField(f.name, common_type(f.dataType, found[f.name.lower()].dataType, prefix + f.name))
        if f.name.lower() in found
        else T.StructField(f.name, f.dataType)
        for f in old.fields
    ]
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in new.fields if f.name.lower() not in known])


def _conform(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return c
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        found = {f.name.lower(): f for f in have.fields}
        fields = [
            _conform(c[found[f.name.lower()].name], found[f.name.lower()].dataType, f.dataType).alias(f.name)
            if f.name.lower() in found
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want.fields
        ]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(c, lambda x: _conform(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(c, lambda k, v: _conform(v, have.valueType, want.valueType))
    return c.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``, absent ones as null."""
    found = {f.name.lower(): f for f in df.schema.fields}
    return df.select(
        *[
            _conform(F.col(f"`{found[f.name.lower()].name}`"), found[f.name.lower()].dataType, f.dataType).alias(f.name)
            if f.name.lower() in found
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def evolve(spark: SparkSession, path: str, new: T.StructType, first: T.StructType) -> T.StructType:
    """The table's columns with those of an increment; kept as the next version if they
    changed. ``first``: what a table that keeps none has.

    A version is a file that is created and never replaced: of two writers that add columns
    at once the later one sees the file and starts over from it. Columns are declared before
    rows come, so readers never meet a row of a column they do not know."""
    while True:
        versions = schema_versions(spark, path)
        old = table_columns(spark, path)
        schema = common_schema(old or first, new)
        if schema == old:
            return schema
        if create_file(spark, f"{path}/{SCHEMA_FOLDER}/{len(versions) + 1:06d}.json", schema.json()):
            return schema
