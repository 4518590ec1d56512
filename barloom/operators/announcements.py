"""Charts that announced themselves, against the symbols a consumer subscribed to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.ordered import last_by
from barloom.schemas import CHART


def announced_charts(hellos: DataFrame) -> DataFrame:
    """The latest category of every announced chart."""
    return last_by(hellos.select("arrival", *CHART, "category"), CHART, "arrival").drop("arrival")


def with_subscription(charts: DataFrame, symbols: DataFrame) -> DataFrame:
    """Mark the charts whose symbol is subscribed; points of others never arrive."""
    subscribed = symbols.select(F.col("id").alias("symbol"), F.lit(True).alias("receiving"))
    return charts.join(subscribed.distinct(), "symbol", "left").withColumn(
        "receiving", F.coalesce("receiving", F.lit(False))
    )


def unsubscribed_charts(charts: DataFrame, symbols: DataFrame) -> DataFrame:
    subscribed = symbols.select(F.col("id").alias("symbol"))
    return charts.join(subscribed, "symbol", "left_anti")


def silent_symbols(symbols: DataFrame, charts: DataFrame) -> DataFrame:
    """Subscribed symbols with no announced chart."""
    announced = charts.select(F.col("symbol").alias("id")).distinct()
    return symbols.select("id").join(announced, "id", "left_anti")
