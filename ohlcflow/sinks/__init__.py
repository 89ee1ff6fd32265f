"""Sinks (SNK-1..6)."""

from .evolve import SchemaConflict
from .writers import (
    batch_writer,
    batch_writer_by_symbol,
    land_payloads,
    merge_bars,
    tick_records,
    write_by_symbol,
    write_documents,
    write_quarantine,
    write_ticks,
)

__all__ = [
    "SchemaConflict",
    "batch_writer",
    "batch_writer_by_symbol",
    "land_payloads",
    "merge_bars",
    "tick_records",
    "write_by_symbol",
    "write_documents",
    "write_quarantine",
    "write_ticks",
]
