"""Counts and latency of frames as received."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.settle import settled
from barloom.operators.sides import staged

COARSE_SECONDS = 86_400


def topic_counts(frames: DataFrame) -> DataFrame:
    """Frames with readable JSON per topic."""
    readable = frames.where(F.try_parse_json("payload").isNotNull())
    return readable.groupBy("topic").agg(F.count("*").alias("frames"))


def most_common(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("frames"), "topic")


def latencies(frames: DataFrame) -> DataFrame:
    """Milliseconds from the publisher's clock to landing, per readable frame."""
    sent = F.coalesce(F.try_variant_get("_v", "$.ts", "double"), F.lit(0.0))
    ms = F.when(F.col("_v").isNotNull(), (F.unix_micros("landed_at") / 1e6 - sent) * 1000.0)
    parsed = frames.withColumn("_v", F.try_parse_json("payload"))
    return parsed.select("arrival", "topic", settled(ms).alias("ms")).where("ms IS NOT NULL")


def _locate(counts: DataFrame, parents: Sequence[str], level: str) -> DataFrame:
    """The buckets that hold a wanted rank, with the ranks counted inside them."""
    upward = Window.partitionBy(*parents).orderBy(level)
    upto = F.sum("_n").over(upward.rowsBetween(Window.unboundedPreceding, 0))
    hits = F.transform(
        F.filter(
            "_ranks", lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_upto"))
        ),
        lambda r: F.struct(r["name"].alias("name"), (r["rank"] - F.col("_before")).alias("rank")),
    )
    placed = counts.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))
    return placed.select(level, hits.alias("_ranks")).where(F.size("_ranks") > 0)


def _wanted_ranks(n: Column) -> Column:
    """Zero-based ranks: both middle elements, and index `int(n * p)` for p95, p99."""

    def rank(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), value.cast("bigint").alias("rank"))

    return F.array(
        rank("low", F.floor((n - 1) / 2)),
        rank("high", F.floor(n / 2)),
        rank("p95", F.least(F.floor(n * 0.95), n - 1)),
        rank("p99", F.least(F.floor(n * 0.99), n - 1)),
    )


def latency_percentiles(frames: DataFrame) -> DataFrame:
    """Exact p50 (interpolated), p95, p99 and max in milliseconds, one row.

    The wanted ranks are followed from days to seconds to values. Each step counts
    the rows of at most four buckets, so nothing is sorted as a whole; four rows
    is also the bound of what is broadcast.
    """
    values = staged(latencies(frames).where(~F.isnan("ms")).select("ms"), "latencies").select(
        "ms",
        F.floor(F.col("ms") / (1000 * COARSE_SECONDS)).alias("_day"),
        F.floor(F.col("ms") / 1000).alias("_second"),
    )
    days = values.groupBy("_day").agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())
    in_days = _locate(days.withColumn("_ranks", _wanted_ranks(total)), [], "_day")
    in_days = staged(in_days, "days")

    seconds = (
        values.join(F.broadcast(in_days.select("_day")), "_day")
        .groupBy("_day", "_second")
        .agg(F.count("*").alias("_n"))
        .join(F.broadcast(in_days), "_day")
    )
    in_seconds = staged(_locate(seconds, ["_day"], "_second"), "seconds")

    exact = (
        values.join(F.broadcast(in_seconds.select("_second")), "_second")
        .groupBy("_second", "ms")
        .agg(F.count("*").alias("_n"))
        .join(F.broadcast(in_seconds), "_second")
    )
    found = _locate(exact, ["_second"], "ms").select(
        "ms", F.explode(F.transform("_ranks", lambda r: r["name"])).alias("name")
    )

    def named(name: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col("ms")))

    picked = found.agg(
        ((named("low") + named("high")) / 2).alias("p50_ms"),
        named("p95").alias("p95_ms"),
        named("p99").alias("p99_ms"),
    )
    summary = values.agg(F.count("*").alias("frames"), F.max("ms").alias("max_ms"))
    columns = ["frames", "p50_ms", "p95_ms", "p99_ms", "max_ms"]
    both = summary.unionByName(picked, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in columns])
