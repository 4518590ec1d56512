"""Feed data derived from the given tables, for the registered queries.

`events` becomes raw frames (one per event, some damaged by what `props` holds)
and bars; `orders` becomes wall-clock stamps on all days of the year.
"""

from __future__ import annotations

from datetime import date, time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import timeconv as tc
from barloom.functions.settle import settled
from barloom.operators.completeness import Scope
from barloom.schemas import (
    BAR_COLUMNS,
    CONTROL_TOPIC,
    DAILY,
    HELLO_KEYS,
    MINUTE,
    POINT_KEYS,
    TICK,
)
from barloom.sources.symbols import symbols_table

SYMBOL_ROWS = [
    {"id": "signup", "category": "breadth", "role": "context"},
    {"id": "error", "category": "etf", "role": "trade"},
    {"id": "view", "category": "volatility", "role": "context", "pre_market_window_minutes": 240},
    {"id": "click", "category": "mega_cap", "role": "context"},
    {"id": "logout", "category": "mega_cap", "role": "context"},
]
CATEGORIES = {"signup": 2, "error": 4, "view": 2, "click": 0, "purchase": 12}
HOURLY = Scope(
    start=date(2024, 1, 1),
    end=date(2024, 1, 30),
    start_time=time(6, 0),
    end_time=time(20, 0),
    holidays=(date(2024, 1, 15),),
    bar_interval=60,
)
MICROS_PER_MINUTE = 60_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def symbols(spark: SparkSession) -> DataFrame:
    return symbols_table(spark, SYMBOL_ROWS)


def _category(symbol: Column) -> Column:
    code = F.lit(None).cast("bigint")
    for name, value in CATEGORIES.items():
        code = F.when(symbol == name, F.lit(value).cast("bigint")).otherwise(code)
    return code


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table of few files; one of many files stays as it lies."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with `k` (what `props` holds) and microseconds."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
    )


def frames(spark: SparkSession, sf_dir: str, part: Column | None = None) -> DataFrame:
    """One frame per event, of all or of the part of events that `landed_at` chooses. A
    point's time lies `value` seconds before the event, so points arrive out of order; `k`
    below 19 damages or reroutes a frame. Payloads are written for that part alone."""
    k, user = F.col("k"), F.col("user_id")
    landed = events(spark, sf_dir).withColumn("landed_at", F.timestamp_micros(F.col("us") + k * 1000 + user * 7))
    bar_type = F.when(user < 30, TICK).otherwise(MINUTE)
    interval = F.when(user < 4, 5).when(user < 30, 1).when(user < 90, 60).otherwise(15)
    ev = (
        spread(landed if part is None else landed.where(part))
        .withColumn("stamp_us", F.col("us") - F.col("cents") * 10_000)
        .withColumns({"bar_type": bar_type.cast("bigint"), "bar_interval": interval.cast("bigint")})
    )
    step = F.col("bar_interval") * MICROS_PER_MINUTE
    label_us = F.when(F.col("bar_type") == TICK, F.col("stamp_us")).otherwise(
        (F.floor(F.col("stamp_us") / step) + 1) * step
    )
    label = F.date_format(tc.wall_clock(F.timestamp_micros(label_us)), "yyyy-MM/dd-HH:mm:ss")
    week = F.date_trunc("week", F.timestamp_micros("us"))
    field = {
        "proto": F.when(k.isin(2, 18), 1).otherwise(2),
        "seq": F.when(
            ~k.isin(3, 17), F.floor(F.col("stamp_us") / MICROS_PER_MINUTE) - 28_400_000
        ),
        "sid": F.unix_micros(week),
        "ts": F.col("us") / 1e6,
        "ts_str": F.when(k == 4, F.concat("label", F.lit(" 上午"))).when(k != 5, F.col("label")),
        "category": _category(F.col("event_type")),
        "o": F.col("value"),
        "h": F.col("value") + k * 0.01,
        "l": F.col("value") - k * 0.01,
        "c": F.col("value"),
        "el_volume": F.when(k == 16, F.lit(10_000_000_000_000_000)).when(
            k != 7, k + F.when(user > 140, 1).otherwise(0)
        ),
        "el_ticks": F.when(k != 6, k + user),
        "el_upticks": k,
        "el_downticks": user,
        "el_open_interest": user + F.when(k > 50, 1).otherwise(0),
        "bid": F.when(k == 10, 0.0).otherwise(F.col("value") - 0.01),
        "ask": F.when(k != 10, F.col("value") + 0.01),
        "symbol": F.when(k != 15, F.col("event_type")),
    }
    filled = ev.withColumn("label", label).withColumns(field)
    with_nulls = {"ignoreNullFields": "false"}
    point = F.struct(*POINT_KEYS)
    text = F.to_json(point, with_nulls)
    payload = (
        F.when(k == 0, "not json")
        .when(k == 1, "[1]")
        .when(k.isin(3, 5, 7), F.to_json(point))
        .when(k == 8, F.to_json(F.struct(*POINT_KEYS, F.lit("tick").alias("kind")), with_nulls))
        .when(k == 9, F.regexp_replace(text, '"proto":2', '"proto":2.0'))
        .when(k == 11, F.regexp_replace(text, r'"seq":\d+', '"seq":"abc"'))
        .when(k.isin(13, 15, 18), F.to_json(F.struct(*HELLO_KEYS), with_nulls))
        .when(k == 14, F.lit(None))
        .otherwise(text)
    )
    topic = (
        F.when(k.isin(13, 15, 18), CONTROL_TOPIC)
        .when(k == 12, F.concat("event_type", F.lit("G")))
        .otherwise(F.col("event_type"))
    )
    return filled.select(
        F.col("event_id").alias("arrival"),
        topic.alias("topic"),
        settled(payload).alias("payload"),
        F.when(k == 14, "�").alias("payload_invalid_utf8"),
        "landed_at",
    )


def _bar_quantities() -> list[Column]:
    k, up = F.col("k"), F.col("value") >= 20
    ups = F.sum(F.when(up, k).otherwise(0))
    downs = F.sum(F.when(up, 0).otherwise(k))
    return [
        (ups + F.count_if(F.col("user_id") > 140)).alias("el_volume"),
        F.sum(k).alias("el_ticks"),
        ups.alias("el_upticks"),
        downs.alias("el_downticks"),
        (downs + F.count_if(F.col("value") > 200)).alias("el_open_interest"),
    ]


def _bars(grouped, instant: Column, bar_type: int, interval: int) -> DataFrame:
    formed = grouped.agg(
        F.min_by("value", "event_id").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "event_id").alias("close"),
        *_bar_quantities(),
        F.max("us").alias("_us"),
    )
    rows = formed.withColumn("bar_time", instant).withColumns(
        {
            "bar_time_et": tc.wall_clock(F.col("bar_time")),
            "category": _category(F.col("symbol")),
            "bid": F.when(F.col("close") >= 5, F.col("close") - 0.01),
            "ask": F.col("close") + 0.01,
            "ts": F.col("_us") / 1e6,
            "bartype": F.lit(bar_type).cast("bigint"),
            "interval": F.lit(interval).cast("bigint"),
        }
    )
    columns = [*BAR_COLUMNS, "bartype", "interval", "symbol"]
    if bar_type != DAILY:
        rows = rows.withColumn("date", tc.partition_date(F.col("bar_time")))
        columns.append("date")
    return rows.select(*columns)


def bars(spark: SparkSession, sf_dir: str, minutes: int = 60) -> DataFrame:
    """Intraday bars: events per type and bucket, labelled by the bucket's end."""
    step = minutes * MICROS_PER_MINUTE
    ev = events(spark, sf_dir).withColumn("bucket", F.floor(F.col("us") / step))
    grouped = ev.groupBy(F.col("event_type").alias("symbol"), "bucket")
    return _bars(grouped, F.timestamp_micros((F.col("bucket") + 1) * step), MINUTE, minutes)


def daily_bars(spark: SparkSession, sf_dir: str, part: Column | None = None) -> DataFrame:
    """Daily bars per Eastern date, labelled 16:00; of all events or a part."""
    ev = events(spark, sf_dir)
    if part is not None:
        ev = ev.where(part)
    dated = ev.withColumn("day", tc.partition_date(F.timestamp_micros("us")))
    grouped = dated.groupBy(F.col("event_type").alias("symbol"), "day")
    return _bars(grouped, tc.session_close(F.col("day")), DAILY, 1)


def repeated_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows with repeats: every event as a row of its hour's bar. Events of
    users below 30 form tick partitions."""
    step = 60 * MICROS_PER_MINUTE
    return events(spark, sf_dir).select(
        F.col("event_id").alias("landing"),
        F.when(F.col("user_id") < 30, TICK).otherwise(MINUTE).cast("bigint").alias("bartype"),
        F.lit(60).cast("bigint").alias("interval"),
        F.col("event_type").alias("symbol"),
        F.timestamp_micros((F.floor(F.col("us") / step) + 1) * step).alias("bar_time"),
        F.col("value").alias("close"),
    ).withColumn("date", tc.partition_date(F.col("bar_time")))


def order_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local wall clocks on every order date; the second of day comes from the price."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    wall = F.timestamp_seconds(
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.pmod(cents, F.lit(86_400))
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("symbol"),
        F.date_format(wall, "yyyy-MM/dd-HH:mm:ss").alias("ts_str"),
        F.col("o_totalprice").alias("price"),
    )


def order_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as numbered frames: one counter over all, one topic per priority, so
    every topic misses the numbers of the others."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("arrival"),
        F.unix_micros(F.lit("2024-01-01").cast("timestamp")).alias("sid"),
        F.col("o_orderpriority").alias("topic"),
        (F.col("o_orderkey") + 1).alias("seq"),
    )
