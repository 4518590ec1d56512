"""Schemas and protocol constants. Every schema is closed: never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the wire protocol and the market calendar.
PROTOCOL = 2
CONTROL_TOPIC = "__ts2py__"
EASTERN = "America/New_York"
WALL_CLOCK_FORMAT = "yyyy-M/d-H:m:s"
WALL_CLOCK_PATTERN = r"^\d{4}-\d{1,2}/\d{1,2}-\d{1,2}:\d{1,2}:\d{1,2}$"
SESSION_CUTOFF_SECONDS = 4 * 3600
SESSION_OPEN_SECONDS = 9 * 3600 + 30 * 60
SESSION_CLOSE_SECONDS = 16 * 3600
QUANTITY_LIMIT = 9.0e15
TICK, MINUTE, DAILY = 0, 1, 2

PRICES = ["open", "high", "low", "close"]
WIRE_PRICES = {"open": "o", "high": "h", "low": "l", "close": "c"}
QUANTITIES = ["el_volume", "el_ticks", "el_upticks", "el_downticks", "el_open_interest"]
CHART = ["symbol", "bar_type", "bar_interval"]

POINT_KEYS = [
    "proto", "seq", "sid", "ts", "ts_str", "bar_type", "bar_interval", "category",
    "o", "h", "l", "c", *QUANTITIES, "bid", "ask",
]
HELLO_KEYS = ["proto", "seq", "sid", "ts", "symbol", "category", "bar_type", "bar_interval"]

FRAME = T.StructType(
    [
        T.StructField("arrival", T.LongType(), False),
        T.StructField("topic", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("payload_invalid_utf8", T.StringType()),
        T.StructField("landed_at", T.TimestampType()),
    ]
)

# The stored columns, in order. `bar_time_et` is the same instant as a wall clock.
BAR = T.StructType(
    [
        T.StructField("bar_time", T.TimestampType(), False),
        T.StructField("bar_time_et", T.TimestampNTZType(), False),
        *[T.StructField(c, T.DoubleType(), False) for c in PRICES],
        *[T.StructField(c, T.LongType(), False) for c in QUANTITIES],
        T.StructField("category", T.LongType(), False),
        T.StructField("bid", T.DoubleType()),
        T.StructField("ask", T.DoubleType()),
        T.StructField("ts", T.DoubleType()),
    ]
)
BAR_COLUMNS = BAR.fieldNames()

DAILY_KEYS = T.StructType(
    [
        T.StructField("bartype", T.LongType()),
        T.StructField("interval", T.LongType()),
        T.StructField("symbol", T.StringType()),
    ]
)
INTRADAY_KEYS = T.StructType([*DAILY_KEYS.fields, T.StructField("date", T.DateType())])

IMPUTED = T.StructType([*BAR.fields, T.StructField("imputed", T.BooleanType(), False)])

SYMBOLS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("role", T.StringType(), False),
        T.StructField("session_reset", T.BooleanType()),
        T.StructField("pre_market_window_minutes", T.IntegerType()),
    ]
)


def key_schema(bar_type: int) -> T.StructType:
    """Path keys of a chart kind; daily charts have no date level."""
    return DAILY_KEYS if bar_type == DAILY else INTRADAY_KEYS
