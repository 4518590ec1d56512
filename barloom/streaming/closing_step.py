"""One micro-batch of refresh collapse: the developing bar of each chart is kept
back until a newer one or the clock closes it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import closing
from barloom.operators.decode import POINT_COLUMNS
from barloom.operators.ordered import SEGMENT_WIDTH
from barloom.schemas import CHART, PRICES, QUANTITIES, TICK

# Fixed value: how long after its close a bar still takes refreshes.
GRACE_SECONDS = 2

_TYPES = {
    "arrival": T.LongType(),
    "symbol": T.StringType(),
    "bar_time": T.TimestampType(),
    **{c: T.LongType() for c in ("bar_type", "bar_interval", "category", *QUANTITIES)},
    **{c: T.DoubleType() for c in (*PRICES, "bid", "ask", "ts")},
}
POINT = T.StructType([T.StructField(c, _TYPES.get(c, T.BooleanType())) for c in POINT_COLUMNS])
CHART_STATE = T.StructType([*POINT.fields, T.StructField("closed_through", T.TimestampType())])


def mark(points: DataFrame, state: DataFrame, width: int = SEGMENT_WIDTH) -> DataFrame:
    """Direct points with `stale`; `state` holds per chart its waiting bar, if any, and
    `closed_through`."""
    seen = state.select(
        *CHART,
        F.greatest("bar_time", "closed_through").alias("bar_time"),
        "closed_through",
    )
    return closing.mark_stale(points, seen, width)


def in_hand(marked: DataFrame, state: DataFrame) -> DataFrame:
    """Points that are not stale, and the bars that waited before them."""
    waiting_before = state.where("bar_time IS NOT NULL").select(*POINT_COLUMNS)
    return marked.where("NOT stale").select(*POINT_COLUMNS).unionByName(waiting_before)


def closed_and_waiting(kept: DataFrame, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Collapsed bars split by whether they are closed.

    The newest bar of a chart waits for a newer one; with `now`, it also closes two seconds
    after its `bar_time`.
    """
    bars = closing.collapse(kept)
    newest = bars.groupBy(*CHART).agg(F.max("bar_time").alias("_newest"))
    develops = F.col("bar_time") == F.col("_newest")
    if now is not None:
        develops = develops & (F.col("bar_time") + F.expr(f"INTERVAL {GRACE_SECONDS} SECONDS") > now)
    split = bars.join(newest, CHART).withColumn("waiting", develops).drop("_newest")
    return split.where("NOT waiting").select(*POINT_COLUMNS), split.where("waiting").select(*POINT_COLUMNS)


def step(
    points: DataFrame,
    state: DataFrame,
    now: Column | None = None,
    width: int = SEGMENT_WIDTH,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`(marked, closed, waiting)`: direct points with `stale`, bars and ticks given out,
    and bars kept back."""
    marked = mark(points, state, width)
    closed, waiting = closed_and_waiting(in_hand(marked, state), now)
    ticks = points.where(F.col("bar_type") == TICK).select(*POINT_COLUMNS)
    return marked, closed.unionByName(ticks), waiting


def next_state(state: DataFrame, closed: DataFrame, waiting: DataFrame) -> DataFrame:
    """Per chart the bar still waiting and how far bars were given out."""
    direct = closed.where(F.col("bar_type") != TICK)
    through = state.select(*CHART, "closed_through").unionByName(
        direct.select(*CHART, F.col("bar_time").alias("closed_through"))
    )
    rows = through.unionByName(waiting, allowMissingColumns=True)
    rest = [c for c in POINT_COLUMNS if c not in (*CHART, "arrival")]
    return rows.groupBy(*CHART).agg(
        F.max("closed_through").alias("closed_through"),
        F.max("arrival").alias("arrival"),
        *[F.max_by(c, "arrival").alias(c) for c in rest],
    )
