"""Repeated rows in stored series: dedupe, daily merge and late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import timeconv as tc
from barloom.operators.ordered import SEGMENT_WIDTH, first_rows, max_before, seeded, unseeded
from barloom.schemas import CHART, DAILY, TICK

PARTITION = ["bartype", "interval", "symbol", "date"]


def keep_first(bars: DataFrame, order: Sequence[Column], partition: list[str] | None = None) -> DataFrame:
    """The first row of each `bar_time` per partition; tick rows all stay."""
    partition = partition or PARTITION
    tick = F.col("bartype") == TICK
    first = first_rows(bars.where(~tick), [*partition, "bar_time"], order)
    return first.unionByName(bars.where(tick))


def dedupe_report(bars: DataFrame, partition: list[str] | None = None) -> DataFrame:
    """Rows before and after per partition; tick partitions are skipped."""
    partition = partition or PARTITION
    tick = F.col("bartype") == TICK
    per_time = bars.groupBy(*partition, "bar_time").agg(F.count("*").alias("n"))
    return (
        per_time.groupBy(*partition)
        .agg(
            F.sum("n").alias("rows_before"),
            F.when(tick, F.sum("n"))
            .otherwise(F.count("*"))
            .alias("rows_after"),
        )
        .withColumn("skipped", tick)
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
    )


def dedupe_totals(report: DataFrame) -> DataFrame:
    scanned = ~F.col("skipped")
    return report.agg(
        F.count("*").alias("files_scanned"),
        F.count_if(F.col("rows_removed") > 0).alias("files_touched"),
        F.sum(F.when(scanned, F.col("rows_before")).otherwise(0)).alias("rows_before"),
        F.sum(F.when(scanned, F.col("rows_after")).otherwise(0)).alias("rows_after"),
        F.sum("rows_removed").alias("rows_removed"),
        F.count_if("skipped").alias("tick_files_skipped"),
    )


def merge_last(stored: DataFrame, incoming: DataFrame, order: str, keys: list[str]) -> DataFrame:
    """Stored and incoming rows, the later one where both have a `bar_time`.

    Later means incoming before stored, then by `order`.
    """
    both = stored.withColumn("_generation", F.lit(0)).unionByName(
        incoming.withColumn("_generation", F.lit(1))
    )
    latest = [F.col("_generation").desc(), F.col(order).desc()]
    return first_rows(both, [*keys, "bar_time"], latest).drop("_generation")


def split_late(
    bars: DataFrame, history: DataFrame | None = None, width: int = SEGMENT_WIDTH
) -> DataFrame:
    """Flag rows for a day that a later day of the same chart has already sealed.

    Daily charts have no days to seal. `history` holds the newest sealed `day`
    per chart.
    """
    day = F.when(F.col("bar_type") != DAILY, tc.partition_date(F.col("bar_time")))
    dated = bars.withColumn("day", day)
    ready = seeded(dated, CHART, "arrival", maxima=["day"], history=history, width=width)
    late = F.col("day") < max_before("day", CHART, "arrival")
    return unseeded(ready.withColumn("late", F.coalesce(late, F.lit(False)))).select(
        *bars.columns, "day", "late"
    )
