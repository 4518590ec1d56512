"""Counters and rates of running jobs."""

from __future__ import annotations

import logging
from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from barloom.schemas import TICK

log = logging.getLogger(__name__)

NAMES = (
    "frames_in", "refused", "direct_in", "bars_out", "ticks_out", "refreshed", "stale",
    "subminute_suspected", "late", "waiting", "symbols",
)
COUNTERS = ", ".join(f"{n} bigint" for n in NAMES)

# Aggregates of each output, by the output's name.
WATCHED = {
    "decoded": {"frames_in": "count(1)"},
    "refused": {"refused": "count(1)"},
    "direct": {"direct_in": "count(1)", "stale": "count_if(stale)"},
    "suspected": {"subminute_suspected": "count(1)"},
    "waiting": {"waiting": "count(1)"},
    "closed": {"bars_out": "count(1)", "ticks_out": f"count_if(bar_type = {TICK})"},
    "late": {"late": "count(1)"},
}


class Beat:
    """Counts of one micro-batch, taken while its outputs are written.

    No output is read again for them: each is observed on its way to the file.
    """

    def __init__(self) -> None:
        self._observed: list[Observation] = []

    def watched(self, df: DataFrame, name: str) -> DataFrame:
        observation = Observation(name)
        self._observed.append(observation)
        return df.observe(observation, *[F.expr(value).alias(n) for n, value in WATCHED[name].items()])

    def totals(self, before: dict | None, symbols: int) -> dict:
        """The counters after this batch, given those before it."""
        before = before or dict.fromkeys(NAMES, 0)
        now = {n: int(v or 0) for o in self._observed for n, v in o.get.items()}
        # A point in hand that gave neither a bar out nor a waiting one refreshed one.
        in_hand = now["direct_in"] - now["stale"] + before["waiting"]
        now["refreshed"] = in_hand - (now["bars_out"] - now["ticks_out"]) - now["waiting"]
        held = {"waiting": now["waiting"], "symbols": symbols}
        return {n: before[n] + now.get(n, 0) for n in NAMES} | held


def _asked(counters: Callable | None, *args):
    """What a job has counted; one that cannot be asked ends no report."""
    try:
        return counters(*args) if counters is not None else None
    except Exception:
        log.exception("counters could not be read")
        return None


class Heartbeat(StreamingQueryListener):
    """Keeps the latest progress reports: rows, rates, and the counters of the jobs.

    `counters` are read at each report, so that everything in one stands for one moment:
    `job.counters` of the live job, and `lost` of the counting job. A frame that is refused
    did arrive, so neither number alone says that a feed is sound.
    """

    def __init__(self, keep: int = 100, counters: Callable[[int], dict | None] | None = None, lost: Callable[[], int | None] | None = None) -> None:
        self.reports: deque[dict] = deque(maxlen=keep)
        self._counters, self._lost = counters, lost

    def onQueryStarted(self, event) -> None:
        log.info("query started: %s", event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        report = {
            "batch_id": p.batchId,
            "rows_in": p.numInputRows,
            "rows_per_second": p.processedRowsPerSecond,
        }
        for name, row in p.observedMetrics.items():
            report.update({f"{name}.{k}": v for k, v in row.asDict().items()})
        report.update(self._read(p.batchId, p.batchDuration))
        self.reports.append(report)
        log.info("heartbeat: %s", report)

    def _read(self, batch_id: int, millis: int) -> dict:
        found = _asked(self._counters, batch_id) or {}
        if found:
            last = self.reports[-1].get("bars_out", 0) if self.reports else 0
            found["bars_per_second"] = round((found["bars_out"] - last) / max(millis / 1000, 1e-3), 2)
        return found | ({"messages_lost": _asked(self._lost)} if self._lost else {})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("query terminated: %s", event.id)
