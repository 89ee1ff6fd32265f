"""Total orderings that keep aggregations hash-based.

``min_by``/``max_by`` over a struct ordering falls back to sort-based
aggregation (the buffer is not fixed width), which sorts every input row on
the map side. Packing ``(major, minor)`` into one DECIMAL(38,0) keeps the
buffer fixed width, so Spark plans a HashAggregate with a partial
(map-side) step, and the minor part breaks ties deterministically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2^64 and 2^63: the minor key (any LONG) is shifted into [0, 2^64).
_SHIFT = "CAST('18446744073709551616' AS DECIMAL(38,0))"
_OFFSET = "CAST('9223372036854775808' AS DECIMAL(38,0))"

# Below every value that a major and a minor key take.
_NULL_MAJOR = -5_400_000_000_000_000_000
_NULL_MINOR = -(1 << 63)


def ts_micros(ts: str | Column) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ (session zone UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def packed_order(major: Column, minor: Column | None = None) -> Column:
    """``major`` then ``minor`` as one orderable number; nulls come first.

    ``major`` must stay within +-5.4e18 (any timestamp in microseconds does);
    ``minor`` may be any LONG. A row whose ``major`` or ``minor`` is null still
    has a place in the order: ``min_by`` and ``max_by`` pass over null orders.
    """
    major = F.coalesce(major, F.lit(_NULL_MAJOR))
    if minor is None:
        return major
    minor = F.coalesce(minor.cast("long"), F.lit(_NULL_MINOR))
    return major.cast("decimal(38,0)") * F.expr(_SHIFT) + (minor.cast("decimal(38,0)") + F.expr(_OFFSET))
