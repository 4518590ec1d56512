"""Registered queries that run the live jobs over frames landed in two parts."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.plans import adapters as ad
from barloom.plans import sql
from barloom.plans.wire_queries import (
    CLOSED,
    POINT_LIST,
    RETAINED,
    STEPS,
    CUT,
    closed_table,
    policies,
)
from barloom.session import shared_dir
from barloom.sources import frames as fr
from barloom.sources import store
from barloom.streaming import closing_step
from barloom.streaming.heartbeat import COUNTERS
from barloom.streaming.ingest import Ingest
from barloom.streaming.live_view import LiveViews
from barloom.streaming.loss import LossCounter, caught_up
from barloom.streaming.sinks import Handlers, store_sink, table_sink

QUERIES, ORACLE = {}, {}

def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


def landings(spark, sf_dir, root):
    """Land the frames up to a day, then the rest; a stream of them after each part."""
    early = F.col("landed_at").cast("timestamp_ntz") < F.lit(CUT)
    for part in (early, ~early):
        fr.write_frames(ad.frames(spark, sf_dir, part), f"{root}/landing")
        yield fr.stream_frames(spark, f"{root}/landing", max_files=2**31 - 1)


def live(spark, **parts) -> tuple[Ingest, Callable[[DataFrame], None]]:
    """The closing job, and how it catches up with a stream."""
    job = Ingest(spark, f"{shared_dir(spark)}/ingest-{uuid4().hex}", ad.symbols(spark), **parts)
    return job, lambda stream: job.start(stream, availableNow=True).awaitTermination()


def counter(spark) -> tuple[LossCounter, Callable[[DataFrame], None]]:
    """The counting job, and how it catches up with a stream and stops."""
    job = LossCounter(spark, f"{shared_dir(spark)}/loss-{uuid4().hex}/job", ad.symbols(spark), width=1 << 12)
    return job, lambda stream: caught_up(job.start(stream, processingTime="500 milliseconds")).stop()


def catching_up(spark, sf_dir, *catch_up: Callable[[DataFrame], None]) -> None:
    """Land both parts, once for all jobs, which catch up after each."""
    for stream in landings(spark, sf_dir, f"{shared_dir(spark)}/feed-{uuid4().hex}"):
        for follow in catch_up:
            follow(stream)


def run(spark, sf_dir, **parts) -> Ingest:
    """The closing job; it catches up after each part."""
    job, follow = live(spark, **parts)
    catching_up(spark, sf_dir, follow)
    return job


def counted(spark, sf_dir) -> LossCounter:
    """The counting job, stopped when it has caught up with each part."""
    job, follow = counter(spark)
    catching_up(spark, sf_dir, follow)
    return job


@query(sql.with_(CLOSED, f"SELECT {POINT_LIST} FROM closed"))
def stream_closed_bars(spark, sf_dir):
    """Bars closed by the live job, and those waiting when it stopped."""
    job = run(spark, sf_dir)
    closed = job.table("closed").drop("batch")
    return closed.unionByName(job.drained()).drop("wall_clock_skipped", "wall_clock_repeated")


@query(
    sql.with_(
        STEPS,
        """SELECT topic, count(*) AS frames,
             CAST(sum(greatest(coalesce(seq - expected, 0), 0)) AS BIGINT) AS messages_lost
           FROM seq_steps GROUP BY topic""",
    )
)
def stream_messages_lost(spark, sf_dir):
    return counted(spark, sf_dir).messages_lost().select("topic", "frames", "messages_lost")


@query(
    sql.with_(
        STEPS,
        """SELECT topic, count(*) AS frames,
             CAST(sum(greatest(coalesce(seq - expected, 0), 0)) AS BIGINT) AS messages_lost,
             count(*) FILTER (seq > expected) AS gaps, count(*) FILTER (seq < expected) AS regressions,
             count(*) FILTER (expected IS NULL) AS baselines
           FROM seq_steps GROUP BY topic""",
    )
)
def stream_loss_totals(spark, sf_dir):
    return counted(spark, sf_dir).messages_lost()


@query(sql.with_(STEPS, "SELECT sid, topic, max(seq) AS seq FROM seq_steps GROUP BY ALL"))
def stream_live_counters(spark, sf_dir):
    """The sessions that the counting job still knows."""
    return counted(spark, sf_dir).counters().select("sid", "topic", "seq")


@query(
    sql.with_(
        CLOSED,
        "SELECT arrival, symbol, bar_time FROM marked WHERE stale",
    )
)
def stream_stale_points(spark, sf_dir):
    return run(spark, sf_dir).table("stale").select("arrival", "symbol", "bar_time")


GIVEN = f"""{CLOSED},
dated AS (SELECT *, CAST({sql.et("bar_time")} AS DATE) AS day FROM closed),
given AS (
  SELECT * EXCLUDE (day) FROM (
    SELECT *, max(day) OVER (PARTITION BY symbol, bar_type, bar_interval ORDER BY arrival
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM dated)
  WHERE NOT coalesce(day < newest, false))"""


class Flaky:
    """A sink that cannot be reached the first times."""

    def __init__(self, sink, failures: int) -> None:
        self._sink, self._left = sink, failures

    def __call__(self, bars, batch_id: int) -> None:
        self._left -= 1
        if self._left >= 0:
            raise ConnectionError("not there yet")
        self._sink(bars, batch_id)


@query(
    sql.with_(GIVEN, "SELECT sink, arrival, symbol, bar_time, close FROM given CROSS JOIN (VALUES ('steady'), ('flaky')) s(sink)")
)
def stream_sinks(spark, sf_dir):
    """What two sinks hold in the end, one of which failed on its first two calls."""
    out = f"{shared_dir(spark)}/sinks-{uuid4().hex}"
    steady, flaky = (table_sink(f"{out}/sink={name}") for name in ("steady", "flaky"))
    run(spark, sf_dir, sinks=[("flaky", Flaky(flaky, 2)), ("steady", steady)]).drain()
    return spark.read.parquet(out).select("sink", "arrival", "symbol", "bar_time", "close")


@query(
    sql.with_(
        GIVEN,
        """SELECT 'any' AS handler, arrival, symbol, bar_time FROM given
           UNION ALL SELECT 'error', arrival, symbol, bar_time FROM given WHERE symbol = 'error'""",
    )
)
def stream_handlers(spark, sf_dir):
    """What functions registered for one symbol and for all were called with; one that
    always fails and one that was taken back are beside them."""
    out = f"{shared_dir(spark)}/handlers-{uuid4().hex}"
    handlers = Handlers()
    gone = table_sink(f"{out}/handler=gone")
    handlers.on("view", gone)
    handlers.on_any(Flaky(gone, 2**31))
    handlers.on("error", table_sink(f"{out}/handler=error"))
    handlers.on_any(table_sink(f"{out}/handler=any"))
    handlers.remove(gone, "view")
    run(spark, sf_dir, sinks=[("handlers", handlers)]).drain()
    return spark.read.parquet(out).select("handler", "arrival", "symbol", "bar_time")


@query(sql.with_(GIVEN, "SELECT bar_type AS bartype, bar_interval AS \"interval\", symbol, bar_time, close, el_volume FROM given WHERE bar_type = 1"))
def stream_store(spark, sf_dir):
    """The store that the live job has filled, batch by batch and drained."""
    root = f"{shared_dir(spark)}/live-store-{uuid4().hex}"
    run(spark, sf_dir, sinks=[("store", store_sink(f"{root}/store", f"{root}/staging"))]).drain()
    charts = [store.scan(spark, f"{root}/store", 1, minutes) for minutes in (15, 60)]
    return charts[0].unionByName(charts[1]).select("bartype", "interval", "symbol", "bar_time", "close", "el_volume")


@query(
    sql.with_(
        CLOSED,
        """SELECT (SELECT count(*) FROM sub) AS frames_in,
             (SELECT count(*) FROM sub WHERE k IN (0, 1, 2, 3, 4, 6, 7, 11, 14, 15)) AS refused,
             (SELECT count(*) FROM marked) AS direct_in,
             (SELECT count(*) FROM closed) - (SELECT count(*) FROM charts) AS bars_out,
             (SELECT count(*) FROM pts WHERE bar_type = 0) AS ticks_out,
             (SELECT count(*) FROM kept WHERE back > 1) AS refreshed,
             (SELECT count(*) FROM marked WHERE stale) AS stale,
             (SELECT count(*) FROM kept WHERE high < high_before OR low > low_before) AS subminute_suspected,
             (SELECT count(*) FROM charts) AS waiting,
             (SELECT count(DISTINCT symbol) FROM pts) AS symbols,
             (SELECT CAST(sum(greatest(coalesce(seq - expected, 0), 0)) AS BIGINT) FROM seq_steps) AS messages_lost""",
    ).replace("SELECT (SELECT count(*) FROM sub)", f", charts AS (SELECT DISTINCT symbol, bar_type, bar_interval FROM marked),{sql.SEQ_STEPS} SELECT (SELECT count(*) FROM sub)", 1)
)
def stream_heartbeat(spark, sf_dir):
    """All counters of the live job and the loss of the counting job, read together."""
    (job, closing), (losses, counting) = live(spark), counter(spark)
    catching_up(spark, sf_dir, closing, counting)
    found = job.counters() | {"messages_lost": losses.total_lost()}
    return spark.createDataFrame([found], f"{COUNTERS}, messages_lost bigint").drop("late")


VIEWS = f"""
h AS (SELECT symbol, count(*) AS recent_points, min(bar_time) AS oldest_bar_time,
             max(high) AS recent_high, min(low) AS recent_low FROM held GROUP BY symbol),
lst AS (SELECT symbol, arg_max(session_date, arrival) AS sd, max(arrival) AS last_arrival,
               arg_max(bar_time, arrival) AS last_bar_time, arg_max(close, arrival) AS last_close
        FROM so GROUP BY symbol),
views AS (SELECT l.symbol, {sql.day_text("l.sd")} AS session_date, last_arrival, last_bar_time,
                 last_close, o.bar_time AS open_bar_time, o.open AS open_price, recent_points,
                 oldest_bar_time, recent_high, recent_low
          FROM lst l LEFT JOIN opening o ON o.symbol = l.symbol AND o.session_date = l.sd
          LEFT JOIN h ON h.symbol = l.symbol)"""


def followed(spark, sf_dir) -> LiveViews:
    """The view job over closed bars, which reach it as a stream in two parts."""
    root = f"{shared_dir(spark)}/views-{uuid4().hex}"
    bars = closed_table(spark, sf_dir).select(*closing_step.POINT.fieldNames())
    early = F.col("ts") < F.unix_seconds(F.lit(CUT).cast("timestamp"))
    job = LiveViews(spark, root, policies(spark), default=(False, 60), width=1 << 10)
    for part in (bars.where(early), bars.where(~early)):
        part.write.mode("append").parquet(f"{root}/bars")
        stream = (
            spark.readStream.schema(closing_step.POINT)
            .option("maxFilesPerTrigger", 2**31 - 1)
            .parquet(f"{root}/bars")
        )
        job.start(stream, availableNow=True).awaitTermination()
    return job


@query(sql.with_(f"{RETAINED},{VIEWS}", "SELECT * FROM views"))
def stream_live_views(spark, sf_dir):
    return followed(spark, sf_dir).views()


@query(
    sql.with_(
        f"{RETAINED},{VIEWS}".replace("FROM sess),", f"FROM sess WHERE ts < epoch(TIMESTAMP '{CUT}')),"),
        "SELECT * FROM views",
    )
)
def stream_views_as_of(spark, sf_dir):
    """The views as they were after the first part."""
    return followed(spark, sf_dir).views(batch_id=0)


@query(
    sql.with_(
        RETAINED,
        f"""SELECT symbol, arrival, bar_time, close, {sql.day_text("session_date")} AS session_date
            FROM held""",
    )
)
def stream_recent_points(spark, sf_dir):
    """The points that the views hold, one by one."""
    held = followed(spark, sf_dir).recent()
    return held.select("symbol", "arrival", "bar_time", "close", "session_date")
