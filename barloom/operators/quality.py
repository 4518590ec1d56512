"""Data-quality reports. They count; they never repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import market, whole
from barloom.schemas import CHART, DAILY


def quantities_out_of_range(points: DataFrame) -> DataFrame:
    """Points with a quantity no publisher may send."""
    return points.where(~market.all_quantities_in_range())


def identity_checks(points: DataFrame) -> DataFrame:
    """Per chart, rows that break the measured identities between quantities."""
    daily = F.col("bar_type") == DAILY
    intraday = ~daily
    volume, ticks, up, down, interest = (
        F.col(c)
        for c in ("el_volume", "el_ticks", "el_upticks", "el_downticks", "el_open_interest")
    )
    return points.groupBy(*CHART).agg(
        F.count("*").alias("rows"),
        F.count_if(intraday & (ticks != whole.plus(up, down))).alias("ticks_not_up_plus_down"),
        F.count_if(intraday & (interest != down)).alias("interest_not_down"),
        F.count_if(intraday & (volume != up)).alias("volume_not_up"),
        F.count_if(daily & (F.col("category") == 2) & (ticks != volume)).alias(
            "daily_ticks_not_volume"
        ),
        F.count_if(daily & (F.col("category") == 2) & (down != 0)).alias("daily_down_not_zero"),
    )


def total_volume(bars: DataFrame) -> DataFrame:
    """Traded volume and volume-weighted close per chart; NULL where nothing trades.

    Intraday totals sit in `el_ticks`, daily totals in `el_volume`.
    """
    volume = F.when(F.col("bartype") == DAILY, F.col("el_volume")).otherwise(F.col("el_ticks"))
    traded = F.nullif(whole.total(volume), F.lit(0))
    return bars.groupBy("symbol", "bartype", "interval").agg(
        traded.alias("total_volume"),
        (F.sum(F.col("close") * volume) / traded).alias("vwap"),
        whole.total(F.when(F.col("bartype") == DAILY, F.col("el_open_interest"))).alias("open_interest"),
    )


def daily_against_intraday(daily: DataFrame, intraday: DataFrame) -> DataFrame:
    """The daily bar's volume beside the day's intraday total, as a diagnostic.

    The two are different facts; the ratio corrects neither.
    """
    day = F.to_date("bar_time_et").alias("date")
    per_day = intraday.groupBy("symbol", "date").agg(
        whole.total(F.col("el_ticks")).alias("intraday_total"),
        whole.total(F.col("el_volume")).alias("intraday_up"),
    )
    return (
        daily.select("symbol", day, F.col("el_volume").alias("daily_volume"))
        .join(per_day, ["symbol", "date"])
        .withColumn(
            "ratio", F.col("daily_volume") / F.nullif(F.col("intraday_total"), F.lit(0))
        )
    )
