"""Which bars a store should hold, learned from the bars it does hold.

A chart's times of day restart at the open and close of regular hours, so no
uniform grid fits. A time of day belongs to a symbol's profile when more than
half of its readable days have it. Expected bars are the profile placed on every
calendar day; days come from exploding a date sequence, never from a join.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import timeconv as tc
from barloom.operators.sides import staged
from barloom.schemas import EASTERN, MINUTE

OK, INCOMPLETE, FILE_MISSING = "OK", "INCOMPLETE", "FILE_MISSING"
UNREADABLE, HOLIDAY, WEEKEND = "UNREADABLE", "HOLIDAY", "WEEKEND"
STATUSES = [OK, INCOMPLETE, FILE_MISSING, UNREADABLE, HOLIDAY, WEEKEND]


@dataclass(frozen=True)
class Scope:
    """Days and times of day to look at. Times are close labels in `zone`."""

    start: date
    end: date
    start_time: time = time(9, 30)
    end_time: time = time(16, 0)
    zone: str = EASTERN
    holidays: tuple[date, ...] = field(default=())
    include_weekends: bool = False
    min_reference_days: int = 5
    bar_type: int = MINUTE
    bar_interval: int = 1

    def __post_init__(self) -> None:
        if self.bar_type != MINUTE:
            raise ValueError("expected times exist for intraday minute charts only (bar_type 1)")
        if self.bar_interval < 1:
            raise ValueError(f"bar_interval must be at least 1, got {self.bar_interval}")
        if self.end < self.start:
            raise ValueError("the end date is before the start date")
        if self.end_time <= self.start_time:
            raise ValueError("the end time must be after the start time")

    def is_weekend(self, day: Column) -> Column:
        return F.lit(not self.include_weekends) & (F.weekday(day) >= 5)

    def is_holiday(self, day: Column) -> Column:
        return day.isin(*self.holidays) if self.holidays else F.lit(False)

    def is_due(self, day: Column) -> Column:
        return day.between(self.start, self.end) & ~self.is_weekend(day) & ~self.is_holiday(day)

    def days(self) -> Column:
        return F.explode(F.sequence(F.lit(self.start), F.lit(self.end)))

    def in_window(self, seconds: Column) -> Column:
        return (seconds > tc.seconds_into_day(self.start_time)) & (
            seconds <= tc.seconds_into_day(self.end_time)
        )


def due_bars(bars: DataFrame, scope: Scope) -> DataFrame:
    """Stored bars of the chart kind on the days in scope; prunes partitions."""
    kind = (F.col("bartype") == scope.bar_type) & (F.col("interval") == scope.bar_interval)
    return bars.where(kind & scope.is_due(F.col("date")) & F.col("bar_time").isNotNull())


def _observed_times(bars: DataFrame, scope: Scope) -> DataFrame:
    seconds = tc.seconds_of_day(F.col("bar_time"), scope.zone)
    return (
        due_bars(bars, scope)
        .select("symbol", "date", seconds.alias("tod"))
        .where(scope.in_window(F.col("tod")))
        .distinct()
    )


@dataclass(frozen=True)
class Learned:
    """What a set of bars teaches: reference days per symbol, and the usual times."""

    reference: DataFrame
    profile: DataFrame


def learn(bars: DataFrame, scope: Scope) -> Learned:
    """Scan the bars once; both answers come from the times that were seen."""
    observed = staged(_observed_times(bars, scope), "observed")
    reference = _reference(observed, scope)
    return Learned(reference, staged(_profile(observed, reference), "profile"))


def reference_days(bars: DataFrame, scope: Scope) -> DataFrame:
    """Per symbol the days with any bar in the window, and whether they suffice."""
    return _reference(_observed_times(bars, scope), scope)


def _reference(observed: DataFrame, scope: Scope) -> DataFrame:
    days = observed.groupBy("symbol", "date").agg(F.count("*").alias("n"))
    return days.groupBy("symbol").agg(
        F.count("*").alias("reference_days"),
        (F.count("*") >= scope.min_reference_days).alias("trusted"),
    )


def discovered_symbols(bars: DataFrame, scope: Scope) -> DataFrame:
    kind = (F.col("bartype") == scope.bar_type) & (F.col("interval") == scope.bar_interval)
    return bars.where(kind).select("symbol").distinct()


def thin_symbols(
    bars: DataFrame,
    scope: Scope,
    symbols: DataFrame | None = None,
    reference: DataFrame | None = None,
) -> DataFrame:
    """Symbols with too few days to learn from; each counts as one error.

    `symbols` are those asked for, with or without data; by default all that have some.
    """
    symbols = discovered_symbols(bars, scope) if symbols is None else symbols.select("symbol").distinct()
    reference = reference_days(bars, scope) if reference is None else reference
    return (
        symbols.join(reference, "symbol", "left")
        .select("symbol", F.coalesce("reference_days", F.lit(0)).alias("reference_days"), "trusted")
        .where(~F.coalesce("trusted", F.lit(False)))
        .drop("trusted")
    )


def profile(bars: DataFrame, scope: Scope) -> DataFrame:
    """Learned times of day per trusted symbol, as seconds of day."""
    observed = _observed_times(bars, scope)
    return _profile(observed, _reference(observed, scope))


def _profile(observed: DataFrame, reference: DataFrame) -> DataFrame:
    slots = observed.groupBy("symbol", "tod").agg(F.count("*").alias("days_seen"))
    trusted = reference.where("trusted").drop("trusted")
    return slots.join(trusted, "symbol").where(2 * F.col("days_seen") > F.col("reference_days"))


def expected_bars(slots: DataFrame, scope: Scope) -> DataFrame:
    """The profile placed on every due day."""
    days = slots.select("symbol", "tod", scope.days().alias("date")).where(
        scope.is_due(F.col("date"))
    )
    return days.select(
        "symbol", "date", tc.place(F.col("date"), F.col("tod"), scope.zone).alias("bar_time")
    )


def reconcile(bars: DataFrame, slots: DataFrame, scope: Scope) -> DataFrame:
    """Every (symbol, day, bar_time) that is expected or stored.

    One grouping replaces both set differences; its key holds the time, so a hot
    symbol spreads over all tasks.
    """
    expected = expected_bars(slots, scope).select(
        "*", F.lit(1).alias("_expected"), F.lit(0).cast("bigint").alias("_stored")
    )
    stored = due_bars(bars, scope).select(
        "symbol", "date", "bar_time", F.lit(0).alias("_expected"), F.lit(1).cast("bigint").alias("_stored")
    )
    return (
        expected.unionByName(stored)
        .groupBy("symbol", "date", "bar_time")
        .agg(
            (F.max("_expected") == 1).alias("is_expected"),
            F.sum("_stored").alias("stored_rows"),
        )
    )


def missing_bars(slots: DataFrame) -> DataFrame:
    return slots.where("is_expected AND stored_rows = 0").select("symbol", "date", "bar_time")


def extra_bars(slots: DataFrame, trusted: DataFrame) -> DataFrame:
    """Distinct stored times that nobody expects, per symbol and day."""
    extra = slots.where("NOT is_expected").join(trusted.select("symbol"), "symbol", "left_semi")
    return extra.groupBy("symbol", "date").agg(F.count("*").alias("extra"))


def day_report(
    bars: DataFrame,
    scope: Scope,
    unreadable_days: DataFrame | None = None,
    learned: Learned | None = None,
    slots: DataFrame | None = None,
) -> DataFrame:
    """One row per (trusted symbol, calendar day) with status and counts.

    `unreadable_days(symbol, date)` lists days whose files could not be read. What was
    learned and reconciled before can be handed in.
    """
    learned = learned or learn(bars, scope)
    trusted = learned.reference.where("trusted").select("symbol")
    sizes = learned.profile.groupBy("symbol").agg(F.count("*").alias("profile_size"))
    slots = reconcile(bars, learned.profile, scope) if slots is None else slots
    per_day = (
        slots.groupBy("symbol", "date")
        .agg(
            F.sum("stored_rows").alias("stored"),
            F.count_if(F.expr("is_expected AND stored_rows = 0")).alias("missing_n"),
            F.count_if(~F.col("is_expected")).alias("extra_n"),
        )
    )
    calendar = trusted.select("symbol", scope.days().alias("date"))
    joined = calendar.join(sizes, "symbol", "left").join(per_day, ["symbol", "date"], "left")
    if unreadable_days is None:
        joined = joined.withColumn("_unreadable", F.lit(False))
    else:
        broken = unreadable_days.select("symbol", "date").distinct()
        joined = joined.join(
            broken.withColumn("_unreadable", F.lit(True)), ["symbol", "date"], "left"
        )
    day, stored = F.col("date"), F.coalesce("stored", F.lit(0))
    status = (
        F.when(scope.is_weekend(day), WEEKEND)
        .when(scope.is_holiday(day), HOLIDAY)
        .when((stored == 0) & F.coalesce("_unreadable", F.lit(False)), UNREADABLE)
        .when(stored == 0, FILE_MISSING)
        .when(F.col("missing_n") > 0, INCOMPLETE)
        .otherwise(OK)
    )
    seen = F.col("status").isin(OK, INCOMPLETE)
    due = seen | F.col("status").isin(FILE_MISSING, UNREADABLE)
    size = F.coalesce("profile_size", F.lit(0))
    return joined.withColumn("status", status).select(
        "symbol",
        "date",
        "status",
        F.when(seen, stored).otherwise(0).alias("rows"),
        F.when(due, size).otherwise(0).alias("expected"),
        F.when(seen, F.coalesce("missing_n", F.lit(0)))
        .when(F.col("status") == FILE_MISSING, size)
        .otherwise(0)
        .alias("missing"),
        F.when(seen, F.coalesce("extra_n", F.lit(0))).otherwise(0).alias("extra"),
    )


def gap_runs(slots: DataFrame) -> DataFrame:
    """Missing bars that are neighbours in the expected series, as runs.

    Windows are per (symbol, day): at most one row per time of day.
    """
    per_day = Window.partitionBy("symbol", "date").orderBy("bar_time")
    placed = slots.where("is_expected").withColumn("_pos", F.row_number().over(per_day))
    missing = placed.where(F.col("stored_rows") == 0)
    island = F.col("_pos") - F.row_number().over(per_day)
    return (
        missing.withColumn("_island", island)
        .groupBy("symbol", "date", "_island")
        .agg(
            F.min("bar_time").alias("gap_start"),
            F.max("bar_time").alias("gap_end"),
            F.count("*").alias("bars"),
        )
        .drop("_island")
    )


def gap_text(runs: DataFrame, zone: str = EASTERN, max_runs: int = 3) -> DataFrame:
    """The first runs of a day as text, and how many more there are."""

    def clock(name: str) -> Column:
        return F.date_format(tc.wall_clock(F.col(name), zone), "HH:mm")

    label = F.when(F.col("gap_start") == F.col("gap_end"), clock("gap_start")).otherwise(
        F.concat_ws("-", clock("gap_start"), clock("gap_end"))
    )
    text = F.concat(label, F.lit(" ("), F.col("bars").cast("string"), F.lit(")"))
    per_day = runs.groupBy("symbol", "date").agg(
        F.sort_array(F.collect_list(F.struct("gap_start", text.alias("text")))).alias("_runs"),
        F.count("*").alias("runs"),
    )
    shown = F.transform(F.slice("_runs", 1, max_runs), lambda r: r["text"])
    more = F.when(F.col("runs") > max_runs, F.format_string("+%d more", F.col("runs") - max_runs))
    return per_day.select(
        "symbol", "date", "runs", F.concat_ws(", ", F.concat_ws(", ", shown), more).alias("gaps")
    )


def symbol_counts(report: DataFrame) -> DataFrame:
    """Days per status and missing bars in total, per symbol."""
    return report.groupBy("symbol").agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in STATUSES],
        F.sum("missing").alias("total_missing"),
    )


def cross_summary(counts: DataFrame) -> DataFrame:
    """A verdict per symbol; its wording is a fixed value.

    Without a bad day a symbol is clean; if no day could be read, neither a complete nor
    an incomplete one, all is missing. Otherwise the kinds of bad days are named, both of
    them where only unreadable days are bad.
    """
    gaps, partial = F.col("file_missing"), F.col("incomplete")
    named = F.concat_ws(
        " + ",
        F.when((gaps > 0) | (partial == 0), F.format_string("%dd gap", gaps)),
        F.when((partial > 0) | (gaps == 0), F.format_string("%dd incomplete", partial)),
    )
    bad, readable = gaps + partial + F.col("unreadable"), F.col("ok") + partial
    verdict = F.when(bad == 0, "clean").when(readable == 0, "ALL_MISSING").otherwise(named)
    return counts.withColumn("verdict", verdict)


def totals(counts: DataFrame, thin: DataFrame) -> DataFrame:
    """Bad days (a symbol without profile counts once) and missing bars overall."""
    bad = F.col("incomplete") + F.col("file_missing") + F.col("unreadable")
    rows = counts.select("symbol", bad.alias("bad"), F.col("total_missing").alias("missing"))
    errors = thin.select("symbol", F.lit(1).cast("bigint").alias("bad"), F.lit(0).cast("bigint").alias("missing"))
    return rows.unionByName(errors).agg(
        F.coalesce(F.sum("bad"), F.lit(0)).alias("overall_bad"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("overall_missing"),
    )
