"""Latest view of every symbol, with session-aware retention.

Everything that must see a whole symbol is an aggregate per (symbol, session);
rows are read again only to pick the few that stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import timeconv as tc
from barloom.operators.ordered import first_rows, last_by
from barloom.operators.sides import staged

RECENT_POINTS = 100


def with_session(points: DataFrame) -> DataFrame:
    return points.withColumn("session_date", tc.session_date(F.col("bar_time"))).withColumn(
        "session_open", tc.session_open(F.col("session_date"))
    )


def session_stats(points: DataFrame) -> DataFrame:
    """Count, extremes and last close per symbol."""
    return points.groupBy("symbol").agg(
        F.count("*").alias("points"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "arrival").alias("last"),
    )


def recent_points(points: DataFrame, n: int = RECENT_POINTS, keys: list[str] | None = None) -> DataFrame:
    """The last `n` arrived points per symbol, or per chart."""
    return first_rows(points, keys or ["symbol"], [F.col("arrival").desc()], n)


def session_open_bars(points: DataFrame) -> DataFrame:
    """The earliest regular-hours bar of every (symbol, trading date)."""
    regular = with_session(points).where(F.col("bar_time") > F.col("session_open"))
    earliest = [F.col("bar_time").asc(), F.col("arrival").asc()]
    return first_rows(regular, ["symbol", "session_date"], earliest).drop("session_open")


def with_policy(
    points: DataFrame, policies: DataFrame, default: tuple[bool, int | None] | None = None
) -> DataFrame:
    """Attach the session policy; symbols without one get the default or none."""
    listed = policies.withColumn("_listed", F.lit(True))
    joined = points.join(listed, "symbol", "left")
    if default is None:
        return joined.drop("_listed")
    reset, minutes = default
    return joined.withColumns(
        {
            "session_reset": F.coalesce("session_reset", F.lit(reset)),
            "pre_market_window_minutes": F.when(
                F.col("_listed"), F.col("pre_market_window_minutes")
            ).otherwise(F.lit(minutes).cast("int")),
        }
    ).drop("_listed")


def _last_sessions(sessions: DataFrame) -> DataFrame:
    """Per symbol: its last session, the last arrival of any other session (the
    run of the last session starts after it), and the newest session."""
    by_arrival = Window.partitionBy("symbol").orderBy(F.col("last_arrival").desc())
    everything = Window.partitionBy("symbol")
    return (
        sessions.select(
            "symbol",
            "session_date",
            "last_arrival",
            F.row_number().over(by_arrival).alias("_rank"),
            F.lead("last_arrival").over(by_arrival).alias("run_after"),
            F.max("session_date").over(everything).alias("newest_session"),
        )
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def retained_points(
    points: DataFrame,
    policies: DataFrame,
    n: int = RECENT_POINTS,
    default: tuple[bool, int | None] | None = None,
) -> DataFrame:
    """The points a live view would still hold, newest `n` per symbol.

    Reset symbols keep the current session alone and drop its pre-market points
    once a regular-hours bar came. Others keep what is not older than the open of
    the newest session less their window. The last arrival always stays.
    """
    dated = with_session(points)
    sessions = dated.groupBy("symbol", "session_date").agg(F.max("arrival").alias("last_arrival"))
    last = with_policy(_last_sessions(sessions), policies, default)
    last = staged(last.withColumnRenamed("session_date", "last_session"), "last_sessions")

    candidates = dated.join(last, "symbol")
    in_run = (F.col("session_date") == F.col("last_session")) & (
        F.col("run_after").isNull() | (F.col("arrival") > F.col("run_after"))
    )
    first_regular = (
        candidates.where(
            F.col("session_reset") & in_run & (F.col("bar_time") > F.col("session_open"))
        )
        .groupBy("symbol")
        .agg(F.min("arrival").alias("first_regular"))
    )
    reset = F.coalesce(F.col("session_reset"), F.lit(False))
    cutoff = tc.session_open(F.col("newest_session")) - F.make_dt_interval(
        mins=F.col("pre_market_window_minutes")
    )
    by_window = (
        F.col("pre_market_window_minutes").isNull()
        | (F.col("bar_time") >= cutoff)
        | (F.col("arrival") == F.col("last_arrival"))
    )
    by_session = in_run & (
        F.col("first_regular").isNull() | (F.col("arrival") >= F.col("first_regular"))
    )
    first_regular = staged(first_regular, "first_regular")
    kept = candidates.join(first_regular, "symbol", "left").where(
        F.when(reset, by_session).otherwise(by_window)
    )
    return recent_points(kept.select(*points.columns, "session_date"), n)


def snapshot(
    points: DataFrame,
    policies: DataFrame,
    n: int = RECENT_POINTS,
    default: tuple[bool, int | None] | None = None,
    as_of: int | None = None,
) -> DataFrame:
    """One row per symbol: session, last closed bar, opening bar, points held.

    `as_of` looks back to the state after a given arrival.
    """
    seen = points if as_of is None else points.where(F.col("arrival") <= as_of)
    last = last_by(
        with_session(seen).select("symbol", "arrival", "bar_time", "close", "session_date"),
        ["symbol"],
        "arrival",
    ).select(
        "symbol",
        "session_date",
        F.col("arrival").alias("last_arrival"),
        F.col("bar_time").alias("last_bar_time"),
        F.col("close").alias("last_close"),
    )
    opening = session_open_bars(seen).select(
        "symbol",
        "session_date",
        F.col("bar_time").alias("open_bar_time"),
        F.col("open").alias("open_price"),
    )
    held = (
        retained_points(seen, policies, n, default)
        .groupBy("symbol")
        .agg(
            F.count("*").alias("recent_points"),
            F.min("bar_time").alias("oldest_bar_time"),
            F.max("high").alias("recent_high"),
            F.min("low").alias("recent_low"),
        )
    )
    return last.join(opening, ["symbol", "session_date"], "left").join(held, "symbol", "left")
