"""Scans and sources (SRC-1..5)."""

from .files import (
    parse_payloads,
    read_bar_table,
    read_coin_info,
    read_payloads,
    read_quarantine,
    read_raw,
    read_symbols,
)
from .stream import read_tick_stream

__all__ = [
    "parse_payloads",
    "read_bar_table",
    "read_coin_info",
    "read_payloads",
    "read_quarantine",
    "read_raw",
    "read_symbols",
    "read_tick_stream",
]
