"""Days of a chart that take no more rows.

A day is sealed when a later day of its chart has come, or when it is over on the Eastern
calendar and its chart has been quiet for a while. Both halves of the second rule count: a
chart that replays five past days within seconds writes days that are long over, and none
of them may be sealed while it is still being filled. Rows for a sealed day are late.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import timeconv as tc
from barloom.operators import merge
from barloom.operators.ordered import SEGMENT_WIDTH
from barloom.schemas import CHART

QUIET = timedelta(seconds=60)
LATER_DAY, QUIET_DAY = "later_day", "quiet"

#: Per chart its newest day, when rows of it were last taken in, and whether it is sealed.
STATE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("bar_type", T.LongType()),
        T.StructField("bar_interval", T.LongType()),
        T.StructField("day", T.DateType()),
        T.StructField("written", T.TimestampType()),
        T.StructField("sealed", T.BooleanType()),
    ]
)


def quiet_days(state: DataFrame, now: Column, quiet: timedelta = QUIET) -> DataFrame:
    """`state` as time has passed: newest days that are over and quiet become sealed."""
    over = F.col("day") < tc.partition_date(now)
    silent = F.col("written") <= now - F.make_dt_interval(secs=F.lit(quiet.total_seconds()))
    due = F.coalesce(over & silent, F.lit(False))
    return state.withColumn("sealed", F.col("sealed") | due)


def split(bars: DataFrame, state: DataFrame, width: int = SEGMENT_WIDTH) -> DataFrame:
    """Bars with `day` and `late`: whether their day was sealed before them.

    Daily charts have no days to seal: `day` is NULL and no row is late.
    """
    marked = merge.split_late(bars, state.select(*CHART, "day"), width)
    sealed = state.where("sealed").select(*CHART, F.col("day").alias("_sealed"))
    joined = marked.join(sealed, CHART, "left")
    late = F.col("late") | F.coalesce(F.col("day") <= F.col("_sealed"), F.lit(False))
    return joined.withColumn("late", late).select(*marked.columns)


def next_state(state: DataFrame, marked: DataFrame, now: Column) -> DataFrame:
    """The state after the rows of `split` were taken in at `now`."""
    taken = marked.where("NOT late AND day IS NOT NULL").groupBy(*CHART).agg(F.max("day").alias("_day"))
    # A chart's rows may be of its newest day again, or of a newer one.
    both = state.join(taken, CHART, "full")
    fresh = F.coalesce(F.col("_day") >= F.col("day"), F.col("_day").isNotNull())
    return both.select(
        *CHART,
        F.greatest("day", "_day").alias("day"),
        F.when(fresh, now).otherwise(F.col("written")).alias("written"),
        F.when(fresh, F.lit(False)).otherwise(F.col("sealed")).alias("sealed"),
    )


def newly_sealed(before: DataFrame, aged: DataFrame, marked: DataFrame) -> DataFrame:
    """(chart, day, reason) of the days sealed by the passing of time or by these rows.

    `before` and `aged` are the state without and with what time has done to it. A day that
    quiet has sealed is not sealed again by a later day.
    """
    open_before = before.where("NOT sealed").select(*CHART, "day")
    by_quiet = aged.where("sealed").join(open_before, [*CHART, "day"], "left_semi").select(*CHART, "day")
    taken = marked.where("NOT late AND day IS NOT NULL").select(*CHART, "day").distinct()
    still_open = aged.where("NOT sealed").select(*CHART, "day")
    candidates = taken.unionByName(still_open).distinct()
    newest = candidates.groupBy(*CHART).agg(F.max("day").alias("_newest"))
    # Days of this batch alone, and the newest day of before if a later one has come.
    by_later = candidates.join(newest, CHART).where(F.col("day") < F.col("_newest")).drop("_newest")
    return by_later.withColumn("reason", F.lit(LATER_DAY)).unionByName(by_quiet.withColumn("reason", F.lit(QUIET_DAY)))
