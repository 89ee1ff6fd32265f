"""Response checks and quarantine (FLT-1/2/3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RATE_LIMIT_MESSAGE, RESPONSE_ERROR, RESPONSE_SUCCESS


def is_success(response: str = "Response") -> Column:
    """FLT-1 predicate: strictly ``Response == 'Success'`` (null is a reject)."""
    return F.col(response).eqNullSafe(F.lit(RESPONSE_SUCCESS))


def is_not_error(response: str = "Response") -> Column:
    """FLT-2 predicate: anything but ``Response == 'Error'`` (absent is fine)."""
    return ~F.col(response).eqNullSafe(F.lit(RESPONSE_ERROR))


def accept(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Accepted payloads: FLT-1 (batch) or, with ``lenient``, FLT-2 (quotes)."""
    return df.where(is_not_error() if lenient else is_success())


def quarantine(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Rejected payloads: the null-safe negation of :func:`accept`."""
    return df.where(~(is_not_error() if lenient else is_success()))


def reject_class(message: str | Column = "Message") -> Column:
    """FLT-3: ``rate_limited`` for the exact provider message, else ``other``."""
    c = F.col(message) if isinstance(message, str) else message
    return F.when(c.eqNullSafe(F.lit(RATE_LIMIT_MESSAGE)), "rate_limited").otherwise("other")


def classify(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Add ``status``: ``accepted``, ``rate_limited``, ``other``, or ``malformed`` where
    the frame says that a payload was no JSON (column ``malformed``)."""
    ok = is_not_error() if lenient else is_success()
    status = F.when(ok, F.lit("accepted")).otherwise(reject_class())
    if "malformed" in df.columns:
        status = F.when(F.col("malformed"), F.lit("malformed")).otherwise(status)
    return df.withColumn("status", status)
