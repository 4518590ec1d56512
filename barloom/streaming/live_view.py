"""The live view of every symbol, following every arrival.

Arrivals of a trigger are cut into segments and summed up apart from each other; the
summaries of a symbol are joined until one is left, which updates the symbol's state. No
task walks a symbol's rows, however many there are, and the result does not depend on how
they are cut. The state is Spark's own, one value per symbol, and a view is read from it
with the state data source.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from barloom.functions import timeconv as tc
from barloom.operators import retention as ret
from barloom.operators.snapshot import RECENT_POINTS, with_policy, with_session

SEGMENT_ROWS = 1 << 14
FAN = 64  # summaries joined at once

_POINTS = "arrival array<bigint>, bar_us array<bigint>, open array<double>, high array<double>, low array<double>, close array<double>"
_SESSION = "reset boolean, n bigint, session int, run bigint, since_regular bigint, open_us bigint, open_price double"
STATE = f"{_SESSION}, {_POINTS}"
SUMMARY = f"symbol string, part bigint, first_session int, one_session boolean, cuts array<bigint>, `left` array<bigint>, {STATE}"
CHANGED = "symbol string, arrival bigint, points bigint"

_LONGS, _DOUBLES = pa.list_(pa.int64()), pa.list_(pa.float64())
_ARROW = pa.schema(
    [
        ("symbol", pa.string()), ("part", pa.int64()), ("first_session", pa.int32()), ("one_session", pa.bool_()),
        ("cuts", _LONGS), ("left", _LONGS), ("reset", pa.bool_()), ("n", pa.int64()), ("session", pa.int32()),
        ("run", pa.int64()), ("since_regular", pa.int64()), ("open_us", pa.int64()), ("open_price", pa.float64()),
        ("arrival", _LONGS), ("bar_us", _LONGS), *[(c, _DOUBLES) for c in ("open", "high", "low", "close")],
    ]
)
_FIELDS = ("first_session", "one_session", "reset", "n", "session", "run", "since_regular", "open_us", "open_price")
_STATE_FIELDS = tuple(f.strip().split()[0] for f in STATE.split(","))


def _row(summary: ret.Summary, symbol: str, part: int) -> pa.Table:
    line = {"symbol": symbol, "part": part, **{f: getattr(summary, f) for f in _FIELDS}}
    line |= {"cuts": summary.cuts, "left": summary.left, **summary.points}
    return pa.Table.from_arrays([pa.array([line[f.name]], f.type) for f in _ARROW], schema=_ARROW)


def _summary(row: dict, depth: int) -> ret.Summary:
    longs = {c: np.asarray(row[c], np.int64) for c in ("arrival", "bar_us")}
    doubles = {c: np.asarray(row[c], np.float64) for c in ("open", "high", "low", "close")}
    return ret.Summary(
        depth=depth,
        points=longs | doubles,
        cuts=np.asarray(row["cuts"], np.int64),
        left=np.asarray(row["left"], np.int64),
        **{f: row[f] for f in _FIELDS},
    )


def _summed(depth: int):
    """Arrow function: the rows of one segment to its summary."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("arrival")
        column = {c: rows[c].to_numpy() for c in ("session", "session_open_us", "window_us", *ret.VALUES)}
        opens, window = column["session_open_us"], column["window_us"]
        cut = np.where(window >= 0, opens - window, ret.NEVER)
        made = ret.summed(
            rows["reset"][0].as_py(),
            depth,
            column["session"],
            column["bar_us"] > opens,
            cut,
            {c: column[c] for c in ret.VALUES},
        )
        return _row(made, rows["symbol"][0].as_py(), rows["part"][0].as_py())

    return run


def _joined(depth: int):
    """Arrow function: the summaries of neighbouring segments to one."""

    def run(rows: pa.Table) -> pa.Table:
        lines = rows.sort_by("part").to_pylist()
        made = reduce(ret.then, (_summary(r, depth) for r in lines))
        return _row(made, lines[0]["symbol"], lines[0]["part"] // FAN)

    return run


def summaries(bars: DataFrame, policies: DataFrame, default: tuple[bool, int | None] | None = None, depth: int = RECENT_POINTS, width: int = SEGMENT_ROWS) -> DataFrame:
    """One `SUMMARY` row per symbol, for the bars of a table or of a trigger."""
    dated = with_policy(with_session(bars), policies, default)
    window = F.col("pre_market_window_minutes").cast("bigint") * 60_000_000
    reset = F.coalesce(F.col("session_reset"), F.lit(False))
    rows = dated.select(
        "symbol",
        F.floor(F.col("arrival") / width).cast("bigint").alias("part"),
        "arrival",
        F.unix_micros("bar_time").alias("bar_us"),
        *("open", "high", "low", "close"),
        F.unix_date("session_date").alias("session"),
        F.unix_micros("session_open").alias("session_open_us"),
        reset.alias("reset"),
        F.coalesce(window, F.lit(-1)).alias("window_us"),
    )
    parts = rows.groupBy("symbol", "part").applyInArrow(_summed(depth), SUMMARY)
    some = parts.groupBy("symbol", F.floor(F.col("part") / FAN)).applyInArrow(_joined(depth), SUMMARY)
    return some.groupBy("symbol").applyInArrow(_joined(depth), SUMMARY)


class Follower(StatefulProcessor):
    """Keeps one symbol's view: the trigger's summary follows what is held."""

    def __init__(self, depth: int) -> None:
        self._depth = depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._view = handle.getValueState("view", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        lines = [r for frame in rows for r in pa.Table.from_pandas(frame, schema=_ARROW).to_pylist()]
        view = ret.Summary(False, self._depth)
        if self._view.exists():
            held = dict(zip(_STATE_FIELDS, self._view.get()))
            held |= {"first_session": held["session"], "one_session": True, "cuts": [], "left": [len(held["arrival"])]}
            view = _summary(held, self._depth)
        for line in sorted(lines, key=lambda r: r["part"]):
            view = ret.follow(view, _summary(line, self._depth))
        state = [getattr(view, f) if f in _FIELDS else view.points[f].tolist() for f in _STATE_FIELDS]
        self._view.update(tuple(state))
        last = int(view.points["arrival"][-1])
        yield pd.DataFrame({"symbol": [key[0]], "arrival": [last], "points": [len(view.held["arrival"])]})

    def close(self) -> None:
        pass


class LiveViews:
    """A restartable job that keeps one view per symbol under `root`.

    `bars` must come in order of `arrival` from trigger to trigger; within one they may lie
    in any order. `width` is the number of arrivals summed up at once.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        policies: DataFrame,
        default: tuple[bool, int | None] | None = None,
        depth: int = RECENT_POINTS,
        width: int = SEGMENT_ROWS,
    ) -> None:
        self._spark = spark
        self._checkpoint = f"{root.rstrip('/')}/checkpoint"
        self._policies, self._default = policies, default
        self._depth, self._width = depth, width

    def start(self, bars: DataFrame, **trigger) -> StreamingQuery:
        """Follow a stream of closed bars; `trigger` as in `writeStream.trigger`."""
        parts = summaries(bars, self._policies, self._default, self._depth, self._width)
        changed = parts.groupBy("symbol").transformWithStateInPandas(
            statefulProcessor=Follower(self._depth),
            outputStructType=CHANGED,
            outputMode="Update",
            timeMode="None",
        )
        return (
            changed.writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", self._checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"}))
            .start()
        )

    def _state(self, batch_id: int | None, symbols: list[str] | None) -> DataFrame:
        """One row per symbol: its state after a batch, the last one by default."""
        reader = self._spark.read.format("statestore").option("stateVarName", "view")
        if batch_id is not None:
            reader = reader.option("batchId", batch_id)
        state = reader.load(self._checkpoint).select("key.symbol", "value.*")
        return state if symbols is None else state.where(F.col("symbol").isin(symbols))

    def views(self, batch_id: int | None = None, symbols: list[str] | None = None) -> DataFrame:
        """Views after a batch, by default the last one, of all symbols or those asked for."""
        held = {c: _held(c) for c in ("arrival", "bar_us", "high", "low")}
        return self._state(batch_id, symbols).select(
            "symbol",
            F.date_from_unix_date("session").alias("session_date"),
            F.element_at("arrival", -1).alias("last_arrival"),
            F.timestamp_micros(F.element_at("bar_us", -1)).alias("last_bar_time"),
            F.element_at("close", -1).alias("last_close"),
            F.timestamp_micros("open_us").alias("open_bar_time"),
            F.col("open_price"),
            F.size(held["arrival"]).cast("bigint").alias("recent_points"),
            F.timestamp_micros(F.array_min(held["bar_us"])).alias("oldest_bar_time"),
            F.array_max(held["high"]).alias("recent_high"),
            F.array_min(held["low"]).alias("recent_low"),
        )

    def recent(self, batch_id: int | None = None, symbols: list[str] | None = None) -> DataFrame:
        """The points held after a batch, by default the last one, oldest arrival first."""
        held = F.arrays_zip(*[_held(c).alias(c) for c in ret.VALUES])
        points = self._state(batch_id, symbols).select("symbol", F.inline(held))
        timed = points.withColumn("bar_time", F.timestamp_micros("bar_us")).drop("bar_us")
        return timed.withColumn("session_date", tc.session_date(F.col("bar_time")))


def _held(column: str) -> Column:
    """The points of a state that its view holds: all, or a reset symbol's newest."""
    n = F.least(F.coalesce("since_regular", "run"), F.size(column).cast("bigint"))
    n = F.when(F.col("reset"), n).otherwise(F.size(column).cast("bigint"))
    return F.slice(column, (F.size(column) - n + 1).cast("int"), n.cast("int"))
