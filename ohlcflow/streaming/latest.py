"""The last price per symbol on a stream (AGG-3), in keyed state with timers.

A grouped maximum on a stream keeps every key for ever, or (with a window) answers per window.
Here each symbol has one value, the place and price of its last tick, and one timer: when the
watermark has passed ``expiry`` without a newer tick, the symbol is told to be expired and its
state goes. The state is in the checkpoint, so a restarted query goes on with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from ..operators.bars import dedupe_latest
from ..operators.ordering import ts_micros
from ..schemas import TIME_FORMAT
from ..session import has_children
from ..sinks.writers import batch_writer
from .ticks import start_writing

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

LATEST_SCHEMA = StructType(
    [
        StructField("symbol", StringType()),
        StructField("close", DoubleType()),
        StructField("micros", LongType()),
        StructField("expired", BooleanType()),
    ]
)


class LastPrice(StatefulProcessor):
    """One symbol's last tick by ``(time, tie)``; tells it when it changes and when it expires."""

    def __init__(self, expiry_ms: int):
        self.expiry_ms = expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "micros bigint, tie bigint, close double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        have = self.last.get() if self.last.exists() else None
        best = newest = (have[0], have[1], have[2]) if have is not None else None
        for r in rows:
            tick = (r["micros"], r["tie"], r["close"])
            if newest is None or tick[:2] > newest[:2]:
                newest = tick
        if newest is best:
            return
        self.last.update(newest)
        if best is not None:
            self.handle.deleteTimer(self._due(best))
        self.handle.registerTimer(self._due(newest))
        yield Row(symbol=key[0], close=newest[2], micros=newest[0], expired=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last.exists():
            micros, _, close = self.last.get()
            self.last.clear()
            yield Row(symbol=key[0], close=close, micros=micros, expired=True)

    def close(self) -> None:
        pass

    def _due(self, tick) -> int:
        return tick[0] // 1000 + self.expiry_ms


def latest_price_stream(
    ticks: DataFrame,
    watermark: str,
    expiry_seconds: int,
    ts: str = "ts",
    price: str = "price",
    symbol: str = "symbol",
    tiebreak: str | None = None,
) -> DataFrame:
    """AGG-3 on a stream: ``symbol, close, micros, expired`` whenever a symbol's last tick
    changes, and once more, ``expired``, when the watermark is ``expiry_seconds`` past it. A tick that is
    older than what its symbol has shown changes nothing; one behind the watermark is dropped,
    so it cannot bring an expired symbol back. Ticks without a symbol or time take no part."""
    t = ticks.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    tie = F.coalesce(F.col(tiebreak).cast("long"), F.lit(0)) if tiebreak else F.lit(0).cast("long")
    rows = t.where(F.col(symbol).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(symbol).cast("string").alias("symbol"), F.col(ts), ts_micros(ts).alias("micros"), tie.alias("tie"),
        F.col(price).cast("double").alias("close"),
    )
    return rows.groupBy("symbol").transformWithState(
        statefulProcessor=LastPrice(expiry_seconds * 1000),
        outputStructType=LATEST_SCHEMA,
        outputMode="Update",
        timeMode="EventTime",
    )


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Keyed state with timers needs the RocksDB store; queries keep the one they began with."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def start_latest_prices(
    latest: DataFrame, sink_path: str, checkpoint: str, trigger: str | None = "availableNow"
) -> StreamingQuery:
    """Write the changes of :func:`latest_price_stream`, one folder per query and batch."""
    with rocks_state(latest.sparkSession):
        return start_writing(latest, batch_writer(sink_path, "parquet", by=()), checkpoint, trigger, "update")


def read_latest_prices(spark: SparkSession, sink_path: str) -> DataFrame:
    """``symbol, close, time, expired``: what the query told last of every symbol."""
    columns = [StructField(c, t) for c, t in (("written_at", LongType()), ("run", StringType()), ("batch_id", LongType()))]
    schema = StructType(LATEST_SCHEMA.fields + columns)
    if not has_children(spark, sink_path, "run="):
        rows = spark.createDataFrame([], schema)
    else:
        rows = spark.read.schema(schema).parquet(sink_path)
    last = dedupe_latest(rows.drop("written_at", "run"), keys=("symbol",), order_col="batch_id")
    return last.select("symbol", "close", F.date_format(F.timestamp_micros("micros"), TIME_FORMAT).alias("time"), "expired")
