"""Fill expected bars that a day's file lacks, flagged and kept apart.

Values come from real bars of the same day only. Rows of one `bar_time` are first
reduced to what a neighbour needs, so a (symbol, day) window holds at most one
row per time of day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import timeconv as tc
from barloom.operators import completeness as cp
from barloom.operators.sides import staged
from barloom.schemas import BAR_COLUMNS, QUANTITIES

METHODS = ("ffill", "bfill", "interpolate")
DAY = ["symbol", "date"]
PATH_KEYS = ["bartype", "interval", "symbol", "date"]


def neighbours(due: DataFrame, missing: DataFrame, order: str) -> DataFrame:
    """Each missing time with the real bar before and after it on that day.

    Of several rows with one `bar_time`, the one before is their last and the
    one after their first, by `order`.
    """
    # A row without order value still is a neighbour, before all others.
    place = F.coalesce(F.col(order).cast("double"), F.lit(float("-inf")))
    real = due.groupBy(*DAY, "bar_time").agg(
        F.max_by("close", place).alias("close"),
        F.max_by("category", place).alias("last_category"),
        F.min_by("open", place).alias("open"),
        F.min_by("category", place).alias("first_category"),
        F.lit(False).alias("_missing"),
    )
    rows = real.unionByName(missing.withColumn("_missing", F.lit(True)), allowMissingColumns=True)
    before = F.when(
        ~F.col("_missing"),
        F.struct("bar_time", F.col("close").alias("value"), F.col("last_category").alias("category")),
    )
    after = F.when(
        ~F.col("_missing"),
        F.struct("bar_time", F.col("open").alias("value"), F.col("first_category").alias("category")),
    )
    up = Window.partitionBy(*DAY).orderBy("bar_time").rowsBetween(Window.unboundedPreceding, -1)
    down = (
        Window.partitionBy(*DAY)
        .orderBy(F.col("bar_time").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("prev", F.last(before, ignorenulls=True).over(up))
        .withColumn("next", F.last(after, ignorenulls=True).over(down))
        .where("_missing")
        .select(*DAY, "bar_time", "prev", "next")
    )


def fill_value(method: str) -> tuple[Column, Column]:
    """The value of an invented bar and how it was found."""
    prev, nxt = F.col("prev.value"), F.col("next.value")
    no_prev, no_next = F.col("prev").isNull(), F.col("next").isNull()
    if method == "ffill":
        return F.coalesce(prev, nxt), F.when(no_prev, "no_prev→bfill").otherwise(method)
    if method == "bfill":
        return F.coalesce(nxt, prev), F.when(no_next, "no_next→ffill").otherwise(method)
    if method == "interpolate":
        start = F.unix_micros("prev.bar_time")
        span = F.unix_micros("next.bar_time") - start
        elapsed = F.unix_micros("bar_time") - start
        fraction = F.when(span > 0, elapsed / span).otherwise(0.0)
        note = F.when(no_next, "no_next→ffill").when(no_prev, "no_prev→bfill").otherwise(method)
        return F.coalesce(prev + fraction * (nxt - prev), prev, nxt), note
    raise ValueError(f"unknown method: {method!r}")


def invented_bars(
    bars: DataFrame,
    scope: cp.Scope,
    method: str,
    order: str = "ts",
    learned: cp.Learned | None = None,
    slots: DataFrame | None = None,
) -> DataFrame:
    """Rows for the missing times of days that have a file, with a `note`.

    An invented bar is flat, trades nothing and has no quote.
    """
    value, note = fill_value(method)
    learned = learned or cp.learn(bars, scope)
    due = cp.due_bars(bars, scope).join(learned.profile.select("symbol").distinct(), "symbol", "left_semi")
    missing = cp.missing_bars(cp.reconcile(bars, learned.profile, scope) if slots is None else slots)
    found = neighbours(due, missing, order).where("prev IS NOT NULL OR next IS NOT NULL")
    zero, nothing = F.lit(0).cast("bigint"), F.lit(None).cast("double")
    return found.withColumns({"_value": value, "note": note}).select(
        "bar_time",
        tc.wall_clock(F.col("bar_time")).alias("bar_time_et"),
        *[F.col("_value").alias(c) for c in ("open", "high", "low", "close")],
        *[zero.alias(q) for q in QUANTITIES],
        F.coalesce("prev.category", "next.category").alias("category"),
        *[nothing.alias(c) for c in ("bid", "ask", "ts")],
        F.lit(True).alias("imputed"),
        F.lit(scope.bar_type).cast("bigint").alias("bartype"),
        F.lit(scope.bar_interval).cast("bigint").alias("interval"),
        *DAY,
        "note",
    )


def impute(
    bars: DataFrame,
    scope: cp.Scope,
    method: str,
    order: str = "ts",
    learned: cp.Learned | None = None,
    slots: DataFrame | None = None,
) -> DataFrame:
    """A whole copy of the days in scope: real rows as they are, invented rows added."""
    learned = learned or cp.learn(bars, scope)
    trusted = learned.reference.where("trusted").select("symbol")
    real = cp.due_bars(bars, scope).join(trusted, "symbol", "left_semi")
    columns = [*BAR_COLUMNS, "imputed", *PATH_KEYS]
    return (
        real.withColumn("imputed", F.lit(False))
        .select(*columns)
        .unionByName(invented_bars(bars, scope, method, order, learned, slots).select(*columns))
    )


def report(
    bars: DataFrame,
    scope: cp.Scope,
    method: str,
    order: str = "ts",
    learned: cp.Learned | None = None,
    slots: DataFrame | None = None,
) -> DataFrame:
    """What imputing would do per symbol; writes nothing.

    Days with a readable file always offer a neighbour, so no row is skipped.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method: {method!r}")
    days = cp.day_report(bars, scope, None, learned, slots)
    touched = F.col("status") == cp.INCOMPLETE
    return days.groupBy("symbol").agg(
        F.count_if(touched).alias("files_touched"),
        F.sum(F.when(touched, F.col("missing")).otherwise(0)).alias("rows_imputed"),
        F.sum(F.lit(0).cast("bigint")).alias("rows_skipped"),
        F.count_if(F.col("status") == cp.OK).alias("already_ok"),
        F.count_if(F.col("status") == cp.FILE_MISSING).alias("file_missing"),
        F.count_if(F.col("status") == cp.HOLIDAY).alias("holiday"),
        F.count_if(F.col("status") == cp.WEEKEND).alias("weekend"),
    )


def overall(symbol_report: DataFrame) -> DataFrame:
    return symbol_report.agg(
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("files_touched", "rows_imputed", "rows_skipped")
        ]
    )
