"""Eastern-time expressions. The session time zone must be UTC."""

from __future__ import annotations

from datetime import date, datetime, time
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions import whole
from barloom.schemas import (
    EASTERN,
    SESSION_CLOSE_SECONDS,
    SESSION_CUTOFF_SECONDS,
    SESSION_OPEN_SECONDS,
    WALL_CLOCK_FORMAT,
    WALL_CLOCK_PATTERN,
)


def wall_clock(instant: Column, zone: str = EASTERN) -> Column:
    """The wall clock of an instant, without zone."""
    return F.from_utc_timestamp(instant, zone).cast("timestamp_ntz")


def instant_of(wall: Column, zone: str = EASTERN) -> Column:
    """The instant of a wall clock; a repeated hour means its first pass."""
    return F.to_utc_timestamp(wall.cast("timestamp"), zone)


def wall_clock_skipped(wall: Column, zone: str = EASTERN) -> Column:
    """True where clocks jumped over this wall clock."""
    return wall_clock(instant_of(wall, zone), zone) != wall.cast("timestamp_ntz")


def wall_clock_repeated(wall: Column, zone: str = EASTERN) -> Column:
    """True where clocks showed this wall clock twice."""
    return wall_clock(instant_of(wall, zone) + F.expr("INTERVAL 1 HOUR"), zone) == wall.cast("timestamp_ntz")


def parse_wall_clock(text: Column) -> Column:
    """A chart stamp as wall clock; NULL where it does not follow the format."""
    return F.when(
        text.rlike(WALL_CLOCK_PATTERN), F.try_to_timestamp(text, F.lit(WALL_CLOCK_FORMAT))
    )


def floor_minute(instant: Column) -> Column:
    return F.date_trunc("minute", instant)


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds as instant; NULL outside the years 1 to 9999 and for NaN."""
    return F.when(seconds.between(-62135596800.0, 253402300799.0), F.timestamp_seconds(seconds))


def seconds_of_day(instant: Column, zone: str = EASTERN) -> Column:
    wall = wall_clock(instant, zone)
    return (F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)).cast("int")


def place(day: Column, seconds: Column, zone: str = EASTERN) -> Column:
    """The instant at which a zone's clock shows `seconds` into `day`."""
    wall = F.timestamp_seconds(F.unix_seconds(day.cast("timestamp")) + seconds)
    return F.to_utc_timestamp(wall, zone)


def partition_date(instant: Column) -> Column:
    """The Eastern calendar date, the key of the intraday store."""
    return F.to_date(wall_clock(instant))


def session_date(instant: Column) -> Column:
    """The trading date: times before 04:00 Eastern belong to the day before."""
    return F.to_date(wall_clock(instant) - F.expr(f"INTERVAL {SESSION_CUTOFF_SECONDS} SECONDS"))


def session_open(day: Column) -> Column:
    """09:30 Eastern of a trading date."""
    return place(day, F.lit(SESSION_OPEN_SECONDS))


def session_close(day: Column) -> Column:
    """16:00 Eastern of a trading date."""
    return place(day, F.lit(SESSION_CLOSE_SECONDS))


def in_regular_hours(instant: Column) -> Column:
    """Close labels: after the open, up to and including the close."""
    day = session_date(instant)
    return (instant > session_open(day)) & (instant <= session_close(day))


def left_edge(instant: Column, minutes: Column) -> Column:
    """The start label of a bar of full length; wrong for a shortened bar.

    No number of minutes fails; absurd ones give the earliest or latest instant."""
    moved = whole.minus(F.unix_micros(instant), whole.times(minutes.cast("bigint"), F.lit(60_000_000)))
    return F.timestamp_micros(moved)


def bound(value: datetime) -> Column:
    """A caller's range bound: without zone it means Eastern time."""
    aware = value if value.tzinfo else value.replace(tzinfo=ZoneInfo(EASTERN))
    utc = aware.astimezone(ZoneInfo("UTC")).replace(tzinfo=None)
    return F.lit(utc).cast("timestamp_ntz").cast("timestamp")


def eastern_day(value: datetime) -> date:
    """The Eastern calendar day of a caller's bound."""
    aware = value if value.tzinfo else value.replace(tzinfo=ZoneInfo(EASTERN))
    return aware.astimezone(ZoneInfo(EASTERN)).date()


def seconds_into_day(value: time) -> int:
    return value.hour * 3600 + value.minute * 60 + value.second
