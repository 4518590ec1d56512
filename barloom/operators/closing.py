"""Intra-bar refreshes to closed bars.

A chart sends the developing bar again and again under one `bar_time`. Per chart
the last point of each `bar_time` is the closed bar, and points older than the
newest one seen are stale. Tick charts repeat `bar_time` by nature and pass
through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.ordered import (
    SEGMENT_WIDTH,
    last_by,
    max_before,
    seeded,
    unseeded,
    value_before,
)
from barloom.operators.sides import staged
from barloom.schemas import CHART, MINUTE, TICK

BAR_KEY = [*CHART, "bar_time"]


def mark_stale(
    points: DataFrame, history: DataFrame | None = None, width: int = SEGMENT_WIDTH
) -> DataFrame:
    """Direct points with a `stale` flag.

    `history` gives, per chart, the newest `bar_time` seen before this data and
    `closed_through`, up to which bars were already given out.
    """
    direct = points.where(F.col("bar_type") != TICK)
    if history is None:
        ready = seeded(direct, CHART, "arrival", maxima=["bar_time"], width=width)
        stale = F.col("bar_time") < max_before("bar_time", CHART, "arrival")
    else:
        direct = direct.withColumn("closed_through", F.lit(None).cast("timestamp"))
        ready = seeded(
            direct,
            CHART,
            "arrival",
            maxima=["bar_time", "closed_through"],
            history=history.select(*CHART, "bar_time", "closed_through"),
            width=width,
        )
        stale = F.coalesce(
            F.col("bar_time") < max_before("bar_time", CHART, "arrival"), F.lit(False)
        ) | F.coalesce(
            F.col("bar_time") <= max_before("closed_through", CHART, "arrival"), F.lit(False)
        )
    marked = unseeded(ready.withColumn("stale", F.coalesce(stale, F.lit(False))))
    return marked.select(*points.columns, "stale")


def collapse(kept: DataFrame) -> DataFrame:
    """The last point of every bar, with the number of refreshes it took."""
    counts = kept.withColumn("_one", F.lit(1).cast("bigint"))
    rest = [c for c in kept.columns if c not in (*BAR_KEY, "arrival")]
    return (
        counts.groupBy(*BAR_KEY)
        .agg(
            *[F.max_by(c, "arrival").alias(c) for c in rest],
            F.max("arrival").alias("arrival"),
            (F.sum("_one") - 1).alias("refreshes"),
        )
        .select(*kept.columns, "refreshes")
    )


def close_bars(points: DataFrame, width: int = SEGMENT_WIDTH) -> DataFrame:
    """Every closed bar of a finished recording, and every tick."""
    ticks = points.where(F.col("bar_type") == TICK)
    kept = mark_stale(points, width=width).where(~F.col("stale")).drop("stale")
    return collapse(kept).drop("refreshes").unionByName(ticks)


def refresh_steps(kept: DataFrame, width: int = SEGMENT_WIDTH) -> DataFrame:
    """Refreshes with a flag where high fell or low rose against the point before.

    A bar only widens, so such a pair is two bars under one `bar_time`: the mark
    of a chart finer than a minute.
    """
    sizes = kept.select("arrival", *BAR_KEY, "high", "low")
    ready = seeded(sizes, BAR_KEY, "arrival", previous=["high", "low"], width=width)
    ready = ready.select(
        "*",
        value_before("high", BAR_KEY, "arrival").alias("high_before"),
        value_before("low", BAR_KEY, "arrival").alias("low_before"),
    )
    narrowed = (F.col("high") < F.col("high_before")) | (F.col("low") > F.col("low_before"))
    return (
        unseeded(ready)
        .where(F.col("high_before").isNotNull())
        .withColumn("subminute_suspected", narrowed)
    )


def subminute_charts(steps: DataFrame) -> DataFrame:
    """Suspicions per chart and the first bar that raised one."""
    suspected = steps.where("subminute_suspected")
    return suspected.groupBy(*CHART).agg(
        F.count("*").alias("suspected"),
        F.min_by("bar_time", "arrival").alias("first_bar_time"),
        F.min("arrival").alias("first_arrival"),
    )


def ingest_counters(points: DataFrame, width: int = SEGMENT_WIDTH) -> DataFrame:
    """One row of counters for a finished recording."""
    needed = points.select("arrival", *BAR_KEY, "high", "low")
    marked = staged(mark_stale(needed, width=width), "marked")
    kept = marked.where(~F.col("stale")).drop("stale")
    seen = points.agg(
        F.count("*").alias("points_in"),
        F.count_if(F.col("bar_type") == TICK).alias("ticks_out"),
        F.count_distinct("symbol").alias("symbols_seen"),
    )
    per_bar = kept.groupBy(*BAR_KEY).agg(F.count("*").alias("n"))
    bars = per_bar.agg(F.count("*").alias("direct_bars_out"), F.coalesce(F.sum("n"), F.lit(0)).alias("kept"))
    narrowed = refresh_steps(kept, width=width).where("subminute_suspected")
    suspected = narrowed.agg(F.count("*").alias("subminute_suspected"))
    parts = [df.unpivot([], df.columns, "counter", "n") for df in (seen, bars, suspected)]
    counted = parts[0].unionByName(parts[1]).unionByName(parts[2])
    names = ("points_in", "ticks_out", "symbols_seen", "direct_bars_out", "kept", "subminute_suspected")
    row = counted.agg(*[F.max(F.when(F.col("counter") == name, F.col("n"))).alias(name) for name in names])
    # A direct point was dropped, or gave a bar, or refreshed one.
    dropped = F.col("points_in") - F.col("ticks_out") - F.col("kept")
    full = row.withColumns({"refreshed": F.col("kept") - F.col("direct_bars_out"), "stale_dropped": dropped}).drop("kept")
    return full.unpivot([], full.columns, "counter", "n").select("counter", F.col("n").cast("bigint").alias("n"))


def repeated_bar_times(bars: DataFrame, width: int = SEGMENT_WIDTH) -> DataFrame:
    """Minute charts whose neighbouring rows carry one `bar_time`."""
    minute = bars.where(F.col("bar_type") == MINUTE).select("arrival", *CHART, "bar_time")
    ready = seeded(minute, CHART, "arrival", previous=["bar_time"], width=width)
    ready = ready.withColumn("before", value_before("bar_time", CHART, "arrival"))
    return (
        unseeded(ready)
        .where(F.col("bar_time") == F.col("before"))
        .groupBy(*CHART)
        .agg(F.count("*").alias("repeats"), F.min("bar_time").alias("first_bar_time"))
    )


def aggregated_tick_charts(points: DataFrame) -> DataFrame:
    """Tick charts that bundle several prints into one point."""
    bundled = (F.col("bar_type") == TICK) & (F.col("bar_interval") != 1)
    return points.where(bundled).select(*CHART).distinct()


def latest_points(points: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The last arrived point per symbol, or per chart."""
    return last_by(points, keys or ["symbol"], "arrival")
