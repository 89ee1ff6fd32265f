"""``python -m ohlcflow ...`` runs the command line (see :mod:`ohlcflow.cli`)."""

from .cli import main

main()
