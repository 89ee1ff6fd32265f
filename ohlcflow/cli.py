"""Command line for the entry points (what spark-submit runs).

    python -m ohlcflow.cli bars   --raw ROOT --table PATH [--layout packed|folders]
    python -m ohlcflow.cli serve  --table PATH --out PATH [--symbols A,B] [--format json]
    python -m ohlcflow.cli batch  --raw ROOT --table PATH --out PATH [--quarantine PATH] [--layout ...]
    python -m ohlcflow.cli stream --out PATH --checkpoint PATH [--format kafka|parquet]
                                  [--source PATH] [--trigger "10 seconds"|availableNow]
                                  [--option key=value ...]
    python -m ohlcflow.cli plan   --symbols-table PATH --run-date YYYY-MM-DD --out PATH
                                  [--mode reference|aligned]

Every command is one Spark job (or one streaming query) for all symbols.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from .apps import bar_table_to_documents, raw_to_bar_table, run_batch, start_tick_app
from .plans.backfill import backfill_plan
from .session import build_session


def _options(pairs: Sequence[str]) -> dict[str, str]:
    out = {}
    for p in pairs:
        key, _, value = p.partition("=")
        out[key] = value
    return out


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="ohlcflow")
    sub = ap.add_subparsers(dest="command", required=True)
    b = sub.add_parser("bars", help="raw payloads -> bar table")
    b.add_argument("--raw", required=True)
    b.add_argument("--table", required=True)
    b.add_argument("--layout", default="packed", choices=["packed", "folders"])
    s = sub.add_parser("serve", help="bar table -> document collection")
    s.add_argument("--table", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--symbols", default=None)
    s.add_argument("--format", default="json")
    s.add_argument("--option", action="append", default=[])
    a = sub.add_parser("batch", help="bars, then serve")
    a.add_argument("--raw", required=True)
    a.add_argument("--table", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--quarantine", default=None)
    a.add_argument("--layout", default="packed", choices=["packed", "folders"])
    t = sub.add_parser("stream", help="tick records -> per-symbol collection")
    t.add_argument("--out", required=True)
    t.add_argument("--checkpoint", required=True)
    t.add_argument("--format", default="kafka")
    t.add_argument("--source", default=None)
    t.add_argument("--trigger", default="10 seconds")
    t.add_argument("--option", action="append", default=[])
    t.add_argument("--sink-format", default="json")
    t.add_argument("--sink-option", action="append", default=[])
    p = sub.add_parser("plan", help="backfill request plan")
    p.add_argument("--symbols-table", required=True)
    p.add_argument("--run-date", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--mode", default="reference", choices=["reference", "aligned"])
    return ap


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"ohlcflow-{args.command}")
    if args.command == "bars":
        raw_to_bar_table(args.raw, args.table, layout=args.layout).run(spark)
    elif args.command == "serve":
        symbols = args.symbols.split(",") if args.symbols else None
        bar_table_to_documents(args.table, args.out, symbols, args.format, _options(args.option)).run(spark)
    elif args.command == "batch":
        run_batch(spark, args.raw, args.table, args.out, args.quarantine, args.layout)
    elif args.command == "stream":
        q = start_tick_app(
            spark, args.out, args.checkpoint, fmt=args.format, source_path=args.source,
            trigger=args.trigger, sink_fmt=args.sink_format, sink_options=_options(args.sink_option),
            **_options(args.option),
        )
        q.awaitTermination()
    elif args.command == "plan":
        symbols = spark.read.parquet(args.symbols_table)
        backfill_plan(symbols, args.run_date, mode=args.mode).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
