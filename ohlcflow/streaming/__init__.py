"""Structured Streaming jobs (STR-1..4, AGG-2 on streams)."""

from .latest import latest_price_stream, read_latest_prices, start_latest_prices
from .ticks import (
    BAR_SINK_SCHEMA,
    TICK_SINK_SCHEMA,
    compact_bar_sink,
    compact_tick_sink,
    dedupe_stream,
    dropped_as_late,
    ohlcv_stream,
    read_checked,
    read_latest_bars,
    read_sink,
    start_bar_upserts,
    start_checked_consumer,
    start_quote_producer,
    start_tick_consumer,
    tick_stream,
)

__all__ = [
    "BAR_SINK_SCHEMA",
    "TICK_SINK_SCHEMA",
    "compact_bar_sink",
    "compact_tick_sink",
    "dedupe_stream",
    "dropped_as_late",
    "ohlcv_stream",
    "latest_price_stream",
    "read_checked",
    "read_latest_bars",
    "read_latest_prices",
    "read_sink",
    "start_bar_upserts",
    "start_checked_consumer",
    "start_latest_prices",
    "start_quote_producer",
    "start_tick_consumer",
    "tick_stream",
]
