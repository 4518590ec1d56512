"""Where closed bars go: named writers, run in order, each on its own."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.sources import store

log = logging.getLogger(__name__)

Writer = Callable[[DataFrame, int], None]


def fan_out(bars: DataFrame, batch_id: int, sinks: Sequence[tuple[str, Writer]]) -> list[tuple]:
    """Hand one batch to every sink; a failing sink does not stop the next."""
    failures = []
    for name, write in sinks:
        try:
            write(bars, batch_id)
        except Exception as exc:
            log.exception("sink %s failed on batch %s", name, batch_id)
            failures.append((batch_id, name, f"{type(exc).__name__}: {exc}"))
    return failures


class Handlers:
    """A sink of user functions, called per batch for one symbol or for all.

    A failing function is logged; the others still run.
    """

    def __init__(self) -> None:
        self._handlers: list[tuple[str | None, Writer]] = []

    def on(self, symbol: str, fn: Writer) -> None:
        self._handlers.append((symbol, fn))

    def on_any(self, fn: Writer) -> None:
        self._handlers.append((None, fn))

    def remove(self, fn: Writer, symbol: str | None = None) -> bool:
        """Take a function back; False if it was not registered that way."""
        if (symbol, fn) not in self._handlers:
            return False
        self._handlers.remove((symbol, fn))
        return True

    def __call__(self, bars: DataFrame, batch_id: int) -> None:
        for symbol, fn in list(self._handlers):
            chosen = bars if symbol is None else bars.where(F.col("symbol") == symbol)
            fan_out(chosen, batch_id, [(f"handler:{symbol or '*'}", fn)])


def store_sink(root: str, staging: str) -> Writer:
    """Append intraday bars and merge daily bars into the store, each batch once.

    A batch that is run again replaces what it has written before.
    """

    def write(bars: DataFrame, batch_id: int) -> None:
        rows = store.as_bars(bars)
        store.append_batch(rows, root, f"{staging}/intraday", batch_id)
        failed = store.merge_daily(rows, root, f"{staging}/daily")
        if failed:
            raise store.OtherSchema("; ".join(reason for *_, reason in failed))

    return write


def table_sink(path: str) -> Writer:
    """One folder per batch, replaced when the batch is run again."""

    def write(bars: DataFrame, batch_id: int) -> None:
        bars.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write
