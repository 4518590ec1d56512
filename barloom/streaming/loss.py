"""Lost messages of a running feed, with counters that are forgotten.

A counter belongs to a publisher session and topic and needs the largest number it has
seen. Frames of a trigger are cut into segments; each segment is reduced to the runs of
numbers by which it rises, which say how many messages it lost whatever came before. A
topic's state takes the segments up in order. It holds one entry per session id, which
leaves the state when the session has been quiet for the time to live, and the totals,
which stay.
"""

from __future__ import annotations

import time
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from barloom.operators import decode as dec
from barloom.operators.ordered import SEGMENT_WIDTH

DAY_MS = 24 * 3600 * 1000
TOP = 2**63 - 1
TOTALS = "frames bigint, messages_lost bigint, gaps bigint, regressions bigint, baselines bigint"
RISES = (
    "topic string, sid bigint, part bigint, frames bigint, tops bigint, lo array<bigint>, "
    "hi array<bigint>, lost_after array<bigint>, rises_from array<bigint>"
)
_LONGS = pa.list_(pa.int64())
_ARROW = pa.schema(
    [("topic", pa.string()), *[(c, pa.int64()) for c in ("sid", "part", "frames", "tops")],
     *[(c, _LONGS) for c in ("lo", "hi", "lost_after", "rises_from")]]
)


def rises(numbers: np.ndarray) -> dict:
    """What a run of numbers, in order of arrival, does to a counter.

    `lo` and `hi` are the runs of neighbouring numbers by which the largest one grows;
    `lost_after` has the numbers missing behind each run and `rises_from` how many frames
    raised the largest number from each run on. Sums end at the ends of BIGINT.
    """
    largest = np.maximum.accumulate(numbers)
    new = numbers[np.concatenate([[True], largest[1:] > largest[:-1]])]
    starts = np.flatnonzero(np.concatenate([[True], new[1:] - 1 != new[:-1]]))
    ends = np.concatenate([starts[1:], [len(new)]])
    lo, hi = new[starts], new[ends - 1]
    # Neighbours further apart than BIGINT reaches count as far apart as it reaches.
    apart = (lo[1:].astype(np.uint64) - hi[:-1].astype(np.uint64) - np.uint64(1)).astype(object)
    after, total = [0], 0
    for gap in reversed(np.minimum(apart, TOP).tolist()):
        total = min(TOP, total + gap)
        after.append(total)
    return {
        "frames": len(numbers),
        "tops": int(np.sum(numbers == TOP)),
        "lo": lo,
        "hi": hi,
        "lost_after": after[::-1],
        "rises_from": len(new) - starts,
    }


def taken_up(largest: int | None, run: dict) -> tuple[int, dict]:
    """The largest number after a run of frames, and what the run adds to the totals.

    After the largest number that there is, that one is expected again and again.
    """
    lo, hi = run["lo"], run["hi"]
    if largest is None:
        first, lost, gaps, rose = 0, 0, 0, run["rises_from"][0]
    else:
        first = bisect_right(hi, largest)
        if first == len(hi):
            again = run["tops"] if largest == TOP else 0
            return largest, {"frames": run["frames"], "messages_lost": 0, "gaps": 0, "regressions": run["frames"] - again, "baselines": 0}
        lost = min(TOP, max(0, lo[first] - largest - 1))
        gaps = int(lost > 0)
        rose = run["rises_from"][first] - max(0, largest + 1 - lo[first])
    more = {
        "frames": run["frames"],
        "messages_lost": min(TOP, lost + run["lost_after"][first]),
        "gaps": gaps + len(lo) - 1 - first,
        "regressions": run["frames"] - rose - max(0, run["tops"] - 1),
        "baselines": int(largest is None),
    }
    return max(hi[-1], hi[-1] if largest is None else largest), more


def _segment(rows: pa.Table) -> pa.Table:
    """One segment of a counter's frames to its `RISES` row."""
    run = rises(rows.sort_by("arrival")["seq"].to_numpy())
    run |= {c: rows[c][0].as_py() for c in ("topic", "sid", "part")}
    return pa.Table.from_arrays([pa.array([run[f.name]], f.type) for f in _ARROW], schema=_ARROW)


class Counter(StatefulProcessor):
    """One topic: the largest number of each live session, and the totals of all."""

    def __init__(self, ttl_ms: int) -> None:
        self._ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._counters = handle.getMapState("counters", "sid bigint", "seq bigint", self._ttl_ms)
        self._totals = handle.getValueState("totals", TOTALS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in TOTALS.split(", ")]
        totals = dict(zip(names, self._totals.get())) if self._totals.exists() else dict.fromkeys(names, 0)
        lines = [r for frame in rows for r in pa.Table.from_pandas(frame, schema=_ARROW).to_pylist()]
        largest: dict[int, int | None] = {}
        for line in sorted(lines, key=lambda r: r["part"]):
            sid = line["sid"]
            if sid not in largest:
                held = self._counters.getValue((sid,)) if self._counters.containsKey((sid,)) else None
                largest[sid] = held[0] if held else None
            largest[sid], more = taken_up(largest[sid], line)
            totals = {c: min(TOP, totals[c] + more[c]) for c in names}
        for sid, seq in largest.items():
            self._counters.updateValue((sid,), (seq,))
        self._totals.update(tuple(totals.values()))
        yield pd.DataFrame([{"topic": key[0], **totals}])

    def close(self) -> None:
        pass


def caught_up(query: StreamingQuery, seconds: float = 900.0) -> StreamingQuery:
    """Wait until a job that runs on a clock has had a batch without input.

    The first batch of a run does not count: it may be one that was planned before the job
    was last stopped, and knows nothing of what has arrived since.
    """
    until, first = time.monotonic() + seconds, None
    while True:
        for p in query.recentProgress[-1:]:
            first = p.batchId if first is None else first
            if p.numInputRows == 0 and p.batchId > first:
                return query
        if query.exception() is not None:
            raise query.exception()
        if time.monotonic() > until:
            raise TimeoutError(f"no batch without input in {seconds} seconds")
        time.sleep(0.1)


class LossCounter:
    """A restartable job that counts lost messages per topic under `root`.

    A session id that says nothing for `ttl_ms` is forgotten; should it come back, its next
    frame sets a new baseline. Frames must come in order of `arrival` from trigger to
    trigger; `width` is the number of arrivals reduced at once. The job runs on a clock and
    has a batch at every trigger, so it never ends by itself: see `caught_up`.
    """

    def __init__(self, spark: SparkSession, root: str, subscribed: DataFrame | None, ttl_ms: int = DAY_MS, width: int = SEGMENT_WIDTH) -> None:
        self._spark, self._subscribed = spark, subscribed
        self._checkpoint = f"{root.rstrip('/')}/checkpoint"
        self._ttl_ms, self._width = ttl_ms, width

    def start(self, frames: DataFrame, **trigger) -> StreamingQuery:
        """Follow a stream of frames; `trigger` as in `writeStream.trigger`."""
        seen = dec.numbers(frames, self._subscribed)
        part = F.floor(F.col("arrival") / self._width).cast("bigint").alias("part")
        runs = seen.select("topic", "sid", part, "arrival", "seq").groupBy("topic", "sid", "part").applyInArrow(_segment, RISES)
        totals = runs.groupBy("topic").transformWithStateInPandas(
            statefulProcessor=Counter(self._ttl_ms),
            outputStructType=f"topic string, {TOTALS}",
            outputMode="Update",
            timeMode="ProcessingTime",
        )
        return (
            totals.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", self._checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .start()
        )

    def _state(self, name: str, batch_id: int | None) -> DataFrame:
        reader = self._spark.read.format("statestore").option("stateVarName", name)
        if batch_id is not None:
            reader = reader.option("batchId", batch_id)
        return reader.load(self._checkpoint)

    def messages_lost(self, batch_id: int | None = None) -> DataFrame:
        """Totals per topic over the whole run, after a batch, the last one by default."""
        return self._state("totals", batch_id).select("key.topic", "value.*")

    def total_lost(self) -> int | None:
        """Messages lost on all topics so far; None before any numbered frame."""
        return self.messages_lost().agg(F.sum("messages_lost")).first()[0]

    def counters(self, batch_id: int | None = None) -> DataFrame:
        """(sid, topic, seq, expires_ms): the sessions not forgotten yet."""
        held = self._state("counters", batch_id)
        return held.select(
            F.col("user_map_key.sid").alias("sid"), "key.topic", F.col("user_map_value.value.seq").alias("seq"), F.col("user_map_value.ttlExpirationMs").alias("expires_ms")
        )
