"""Registered queries over frames and points, each with its SQL."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import market
from barloom.functions import timeconv as tc
from barloom.operators import (
    announcements as ann,
    closing,
    conformance,
    decode as dec,
    merge,
    quality,
    sealing,
    sequence,
    snapshot as snap,
    wire_report,
)
from barloom.operators.ordered import first_rows
from barloom.operators.sides import staged
from barloom.plans import adapters as ad
from barloom.plans import sql
from barloom.schemas import CHART, QUANTITIES
from barloom.sources import symbols as sym

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames as a table, as a collector would land them."""
    return staged(ad.frames(spark, sf_dir), "frames")


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dec.decode(landed(spark, sf_dir), ad.symbols(spark))


def decoded_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dec.points(decoded(spark, sf_dir))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded points as a table: later steps read the columns they need, and no
    step parses a payload again."""
    return staged(decoded_points(spark, sf_dir), "points")


def policies(spark: SparkSession) -> DataFrame:
    return sym.policies(ad.symbols(spark))


FR = sql.FRAMES
CLOSED = f"{FR},{sql.KEPT}"
POINT_LIST = (
    "arrival, symbol, bar_time, bar_type, bar_interval, category, open, high, low, close, "
    + ", ".join(QUANTITIES)
    + ", bid, ask, ts, time_from_receive_clock"
)


# --- decoding ----------------------------------------------------------------


@query(sql.with_(FR, f"SELECT {POINT_LIST} FROM pts"))
def decode_points(spark, sf_dir):
    return decoded_points(spark, sf_dir).drop("wall_clock_skipped", "wall_clock_repeated")


@query(
    sql.with_(
        FR,
        """SELECT reason AS refusal_reason, count(*) AS frames FROM (
             SELECT CASE
               WHEN k = 14 THEN 'not_utf8' WHEN k = 0 THEN 'bad_json' WHEN k = 1 THEN 'not_an_object'
               WHEN k = 11 THEN 'bad_seq' WHEN k = 2 THEN 'bad_proto' WHEN k = 3 THEN 'missing_seq'
               WHEN k = 4 THEN 'bad_ts_str' WHEN k = 6 THEN 'bad_el_ticks'
               WHEN k = 7 THEN 'missing_el_volume' WHEN k = 15 THEN 'bad_symbol' END AS reason
             FROM sub) WHERE reason IS NOT NULL GROUP BY reason""",
    )
)
def refused_by_reason(spark, sf_dir):
    return dec.refusals_by_reason(decoded(spark, sf_dir))


@query(
    sql.with_(
        FR,
        """SELECT arrival, topic, CASE
             WHEN k = 14 THEN 'not_utf8' WHEN k = 0 THEN 'bad_json' WHEN k = 1 THEN 'not_an_object'
             WHEN k = 11 THEN 'bad_seq' WHEN k = 2 THEN 'bad_proto' WHEN k = 3 THEN 'missing_seq'
             WHEN k = 4 THEN 'bad_ts_str' WHEN k = 6 THEN 'bad_el_ticks'
             WHEN k = 7 THEN 'missing_el_volume' ELSE 'bad_symbol' END AS refusal_reason
           FROM sub WHERE k IN (0, 1, 2, 3, 4, 6, 7, 11, 14, 15)""",
    )
)
def dead_letters(spark, sf_dir):
    return dec.refused(decoded(spark, sf_dir)).select("arrival", "topic", "refusal_reason")


@query(sql.with_(FR, "SELECT arrival, topic FROM sub WHERE topic <> '__ts2py__'"))
def topic_filter(spark, sf_dir):
    routed = dec.route(ad.frames(spark, sf_dir), ad.symbols(spark))
    return routed.where(F.col("route") == dec.POINT).select("arrival", "topic")


@query(
    sql.with_(
        FR,
        """SELECT CASE WHEN topic = '__ts2py__' THEN 'announcement' ELSE 'point' END AS route,
                  count(*) AS frames FROM fr GROUP BY 1""",
    )
)
def route_topics(spark, sf_dir):
    return dec.route(ad.frames(spark, sf_dir)).groupBy("route").agg(F.count("*").alias("frames"))


@query(sql.with_(FR, "SELECT arrival, bid, ask FROM pts"))
def quote_normalize(spark, sf_dir):
    return decoded_points(spark, sf_dir).select("arrival", "bid", "ask")


@query(sql.with_(FR, "SELECT arrival, symbol, bar_time FROM pts WHERE time_from_receive_clock"))
def receive_clock_points(spark, sf_dir):
    flagged = decoded_points(spark, sf_dir).where("time_from_receive_clock")
    return flagged.select("arrival", "symbol", "bar_time")


@query(
    sql.with_(
        FR,
        """SELECT arrival, topic, unnest(CASE
             WHEN k IN (0, 14) THEN CASE WHEN k = 0 THEN ['not_json'] ELSE ['not_json'] END
             WHEN k = 1 THEN ['type:object']
             WHEN k = 2 THEN ['const:proto'] WHEN k = 18 THEN ['const:proto']
             WHEN k = 3 THEN ['missing:seq'] WHEN k = 5 THEN ['missing:ts_str']
             WHEN k = 6 THEN ['type:el_ticks'] WHEN k = 7 THEN ['missing:el_volume']
             WHEN k = 8 THEN ['extra:kind'] WHEN k IN (11, 17) THEN ['type:seq']
             WHEN k = 15 THEN ['type:symbol'] ELSE [] END) AS violation
           FROM fr""",
    )
)
def frame_conformance(spark, sf_dir):
    return conformance.violations(landed(spark, sf_dir))


@query(sql.with_(FR, "SELECT arrival, symbol, el_volume FROM pts WHERE abs(el_volume) > 9e15"))
def quantity_range(spark, sf_dir):
    bad = quality.quantities_out_of_range(points(spark, sf_dir))
    return bad.select("arrival", "symbol", "el_volume")


@query(
    """WITH o AS (
         SELECT o_orderkey, o_orderpriority AS symbol, o_orderdate + to_seconds(
           CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 86400 AS BIGINT)) AS wall FROM orders),
       u AS (SELECT *, timezone('UTC', timezone('America/New_York', wall)) AS late FROM o),
       f AS (
         SELECT *, timezone('America/New_York', timezone('UTC', late)) <> wall AS skipped,
                timezone('America/New_York', timezone('UTC', late - INTERVAL 1 HOUR)) = wall AS again
         FROM u)
       SELECT o_orderkey, symbol,
              date_trunc('minute', CASE WHEN again THEN late - INTERVAL 1 HOUR ELSE late END) AS bar_time,
              skipped AS wall_clock_skipped, again AS wall_clock_repeated FROM f"""
)
def wall_clock_instants(spark, sf_dir):
    wall = tc.parse_wall_clock(F.col("ts_str"))
    return ad.order_stamps(spark, sf_dir).select(
        "o_orderkey",
        "symbol",
        tc.floor_minute(tc.instant_of(wall)).alias("bar_time"),
        tc.wall_clock_skipped(wall).alias("wall_clock_skipped"),
        tc.wall_clock_repeated(wall).alias("wall_clock_repeated"),
    )


# --- announcements -----------------------------------------------------------

CHARTS = f"""{FR},
charts AS (
  SELECT symbol, bar_type, bar_interval, arg_max(category, arrival) AS category
  FROM hellos GROUP BY ALL)"""
SUBSCRIBED = "('signup', 'error', 'view', 'click', 'logout')"


def charts(spark, sf_dir):
    return ann.announced_charts(dec.announcements(decoded(spark, sf_dir)))


@query(
    sql.with_(CHARTS, f"SELECT *, symbol IN {SUBSCRIBED} AS receiving FROM charts")
)
def announced_charts(spark, sf_dir):
    return ann.with_subscription(charts(spark, sf_dir), ad.symbols(spark))


@query(sql.with_(CHARTS, f"SELECT * FROM charts WHERE symbol NOT IN {SUBSCRIBED}"))
def announced_unsubscribed(spark, sf_dir):
    return ann.unsubscribed_charts(charts(spark, sf_dir), ad.symbols(spark))


@query(
    sql.with_(
        CHARTS,
        """SELECT id FROM (VALUES ('signup'), ('error'), ('view'), ('click'), ('logout')) s(id)
           WHERE id NOT IN (SELECT symbol FROM charts)""",
    )
)
def silent_symbols(spark, sf_dir):
    return ann.silent_symbols(ad.symbols(spark), charts(spark, sf_dir))


# --- loss --------------------------------------------------------------------

STEPS = f"{FR},{sql.SEQ_STEPS}"


def seq_steps(spark, sf_dir):
    return sequence.steps(staged(dec.observed(decoded(spark, sf_dir)), "observed"))


@query(
    sql.with_(
        STEPS,
        """SELECT arrival, sid, topic, seq, expected, greatest(coalesce(seq - expected, 0), 0) AS lost,
                  coalesce(seq < expected, false) AS regressed FROM seq_steps""",
    )
)
def gap_report(spark, sf_dir):
    return seq_steps(spark, sf_dir)


@query(
    sql.with_(
        STEPS,
        """SELECT topic, count(*) AS frames,
             CAST(sum(greatest(coalesce(seq - expected, 0), 0)) AS BIGINT) AS messages_lost,
             count(*) FILTER (seq > expected) AS gaps, count(*) FILTER (seq < expected) AS regressions,
             count(*) FILTER (expected IS NULL) AS baselines FROM seq_steps GROUP BY topic""",
    )
)
def loss_by_topic(spark, sf_dir):
    return sequence.loss_by_topic(seq_steps(spark, sf_dir))


@query(
    sql.with_(
        STEPS,
        """SELECT count(*) AS frames,
             CAST(sum(greatest(coalesce(seq - expected, 0), 0)) AS BIGINT) AS messages_lost,
             count(*) > 0 AS gap_detection_available FROM seq_steps""",
    )
)
def loss_total(spark, sf_dir):
    return sequence.loss_total(seq_steps(spark, sf_dir))


@query(
    """WITH s AS (
         SELECT o_orderpriority AS topic, o_orderkey + 1 AS seq, max(o_orderkey + 1) OVER (
                  PARTITION BY o_orderpriority ORDER BY o_orderkey
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS expected FROM orders)
       SELECT topic, count(*) AS frames,
              CAST(sum(greatest(coalesce(seq - expected, 0), 0)) AS BIGINT) AS messages_lost,
              count(*) FILTER (seq > expected) AS gaps, count(*) FILTER (seq < expected) AS regressions,
              count(*) FILTER (expected IS NULL) AS baselines FROM s GROUP BY topic"""
)
def order_number_gaps(spark, sf_dir):
    return sequence.loss_by_topic(sequence.steps(ad.order_numbers(spark, sf_dir)))


# --- frames as received ------------------------------------------------------


@query(
    sql.with_(
        FR, "SELECT topic, count(*) AS frames FROM fr WHERE k NOT IN (0, 14) GROUP BY topic"
    )
)
def topic_counts(spark, sf_dir):
    return wire_report.most_common(wire_report.topic_counts(landed(spark, sf_dir)))


@query(
    sql.with_(
        f"""{FR},
lat AS (
  SELECT (landed_us / 1e6 - CASE WHEN k = 1 THEN CAST(0 AS DOUBLE) ELSE us / 1e6 END)
           * CAST(1000 AS DOUBLE) AS ms FROM fr WHERE k NOT IN (0, 14)),
ranked AS (SELECT ms, row_number() OVER (ORDER BY ms) - 1 AS i, count(*) OVER () AS n FROM lat)""",
        """SELECT max(n) AS frames,
             (max(ms) FILTER (i = (n - 1) // 2) + max(ms) FILTER (i = n // 2)) / 2 AS p50_ms,
             max(ms) FILTER (i = least(CAST(floor(n * CAST(0.95 AS DOUBLE)) AS BIGINT), n - 1)) AS p95_ms,
             max(ms) FILTER (i = least(CAST(floor(n * CAST(0.99 AS DOUBLE)) AS BIGINT), n - 1)) AS p99_ms,
             max(ms) AS max_ms FROM ranked""",
    )
)
def latency_percentiles(spark, sf_dir):
    return wire_report.latency_percentiles(landed(spark, sf_dir))


# --- closed bars -------------------------------------------------------------


def closed(spark, sf_dir):
    return closing.close_bars(points(spark, sf_dir))


def closed_table(spark, sf_dir):
    return staged(closed(spark, sf_dir), "closed")


@query(sql.with_(CLOSED, f"SELECT {POINT_LIST} FROM closed"))
def refresh_collapse(spark, sf_dir):
    return closed(spark, sf_dir).drop("wall_clock_skipped", "wall_clock_repeated")


@query(
    sql.with_(
        CLOSED,
        """SELECT 'points_in' AS counter, count(*) AS n FROM pts
           UNION ALL SELECT 'ticks_out', count(*) FROM pts WHERE bar_type = 0
           UNION ALL SELECT 'direct_bars_out', count(*) FROM kept WHERE back = 1
           UNION ALL SELECT 'refreshed', count(*) FROM kept WHERE back > 1
           UNION ALL SELECT 'stale_dropped', count(*) FROM marked WHERE stale
           UNION ALL SELECT 'subminute_suspected', count(*) FROM kept
                     WHERE high < high_before OR low > low_before
           UNION ALL SELECT 'symbols_seen', count(DISTINCT symbol) FROM pts""",
    )
)
def ingest_counters(spark, sf_dir):
    return closing.ingest_counters(points(spark, sf_dir))


@query(
    sql.with_(
        CLOSED,
        """SELECT symbol, bar_type, bar_interval, count(*) AS suspected,
                  arg_min(bar_time, arrival) AS first_bar_time, min(arrival) AS first_arrival
           FROM kept WHERE high < high_before OR low > low_before GROUP BY ALL""",
    )
)
def subminute_flags(spark, sf_dir):
    kept = closing.mark_stale(points(spark, sf_dir)).where("NOT stale")
    kept = staged(kept.select("arrival", *closing.BAR_KEY, "high", "low"), "kept")
    return closing.subminute_charts(closing.refresh_steps(kept))


@query(
    sql.with_(
        f"""{FR},
b AS (SELECT *, lag(bar_time) OVER (PARTITION BY symbol, bar_type, bar_interval ORDER BY arrival)
        AS before FROM pts WHERE bar_type = 1)""",
        """SELECT symbol, bar_type, bar_interval, count(*) AS repeats, min(bar_time) AS first_bar_time
           FROM b WHERE bar_time = before GROUP BY ALL""",
    )
)
def repeated_bar_times(spark, sf_dir):
    return closing.repeated_bar_times(points(spark, sf_dir))


@query(
    sql.with_(
        FR,
        """SELECT DISTINCT symbol, bar_type, bar_interval FROM pts
           WHERE bar_type = 0 AND bar_interval <> 1""",
    )
)
def aggregated_tick_charts(spark, sf_dir):
    return closing.aggregated_tick_charts(points(spark, sf_dir))


@query(
    sql.with_(
        FR,
        "SELECT symbol, bar_time, ts, close FROM pts WHERE bar_type = 0 ORDER BY ALL",
    )
)
def tick_order(spark, sf_dir):
    """Ticks in order; only `ts` orders them inside a minute. The range sort splits
    a minute that holds very many."""
    ticks = points(spark, sf_dir).where("bar_type = 0")
    return ticks.select("symbol", "bar_time", "ts", "close").orderBy("symbol", "bar_time", "ts")


@query(
    sql.with_(
        f"""{CLOSED},
d AS (SELECT *, CAST({sql.et("bar_time")} AS DATE) AS day FROM pts),
l AS (SELECT *, max(day) OVER (PARTITION BY symbol, bar_type, bar_interval ORDER BY arrival
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sealed FROM d)""",
        f"""SELECT arrival, symbol, bar_time, {sql.day_text("day")} AS day,
                   coalesce(day < sealed, false) AS late FROM l""",
    )
)
def late_rows(spark, sf_dir):
    return merge.split_late(points(spark, sf_dir)).select(
        "arrival", "symbol", "bar_time", "day", "late"
    )


# Bars in two parts, with the clock far beyond the first part's days in between.
CUT = datetime(2024, 1, 16)
CLOCKS = (datetime(2024, 1, 16, 0, 1), datetime(2024, 6, 1), datetime(2024, 6, 2))
SEALING = f"""{CLOSED},
parts AS (SELECT *, CAST({sql.et("bar_time")} AS DATE) AS day, ts < epoch(TIMESTAMP '{CUT}') AS early FROM closed),
walk AS (
  SELECT *, max(day) OVER (PARTITION BY symbol, bar_type, bar_interval ORDER BY early DESC, arrival
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest,
         max(CASE WHEN early THEN day END) OVER (PARTITION BY symbol, bar_type, bar_interval) AS sealed
  FROM parts),
sorted_out AS (
  SELECT *, coalesce(day < newest, false) OR (NOT early AND coalesce(day <= sealed, false)) AS late FROM walk)"""


def sealed_in_steps(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Rows marked late or not, and days as they are sealed, over both parts and a last tick."""
    bars = closed_table(spark, sf_dir)
    early = F.col("ts") < F.unix_seconds(F.lit(CUT).cast("timestamp"))
    state = spark.createDataFrame([], sealing.STATE)
    marked, days = [], []
    for clock, part in zip(CLOCKS, (bars.where(early), bars.where(~early), bars.limit(0))):
        now = F.lit(clock).cast("timestamp")
        aged = staged(sealing.quiet_days(state, now), "aged")
        rows = staged(sealing.split(part, aged), "split")
        marked.append(rows)
        days.append(sealing.newly_sealed(state, aged, rows))
        state = staged(sealing.next_state(aged, rows, now), "sealed")
    return reduce(DataFrame.unionByName, marked), reduce(DataFrame.unionByName, days)


@query(
    sql.with_(
        SEALING,
        f"""SELECT arrival, symbol, bar_time, {sql.day_text("day")} AS day, late FROM sorted_out""",
    )
)
def late_after_quiet(spark, sf_dir):
    """Late rows where a day is sealed by a later day or by having been quiet."""
    return sealed_in_steps(spark, sf_dir)[0].select("arrival", "symbol", "bar_time", "day", "late")


@query(
    sql.with_(
        f"""{SEALING},
taken AS (SELECT DISTINCT symbol, bar_type, bar_interval, early, day FROM sorted_out WHERE NOT late)""",
        f"""SELECT symbol, bar_type, bar_interval, {sql.day_text("day")} AS day,
                   CASE WHEN day < max(day) OVER (PARTITION BY symbol, bar_type, bar_interval, early)
                        THEN 'later_day' ELSE 'quiet' END AS reason
            FROM taken""",
    )
)
def sealed_days(spark, sf_dir):
    return sealed_in_steps(spark, sf_dir)[1]


# --- live views --------------------------------------------------------------


@query(
    sql.with_(
        CLOSED,
        """SELECT symbol, count(*) AS points, max(high) AS high, min(low) AS low,
                  arg_max(close, arrival) AS last FROM closed GROUP BY symbol""",
    )
)
def session_stats(spark, sf_dir):
    return snap.session_stats(closed(spark, sf_dir))


@query(
    sql.with_(
        CLOSED,
        """SELECT symbol, arrival, bar_time, close FROM (
             SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY arrival DESC) AS rn FROM closed)
           WHERE rn <= 100""",
    )
)
def recent_n(spark, sf_dir):
    recent = snap.recent_points(closed(spark, sf_dir), 100)
    return recent.select("symbol", "arrival", "bar_time", "close")


@query(
    sql.with_(
        CLOSED,
        """SELECT symbol, bar_type, bar_interval, max(arrival) AS arrival,
                  arg_max(bar_time, arrival) AS bar_time, arg_max(close, arrival) AS close
           FROM closed GROUP BY ALL""",
    )
)
def latest_bar(spark, sf_dir):
    last = closing.latest_points(closed(spark, sf_dir), list(CHART))
    return last.select(*CHART, "arrival", "bar_time", "close")


SESSIONS = f"""{CLOSED},
sess AS (
  SELECT *, CAST({sql.et("bar_time")} - INTERVAL 4 HOUR AS DATE) AS session_date FROM closed),
so AS (
  SELECT *, {sql.utc("session_date + INTERVAL 570 MINUTE")} AS session_open FROM sess),
opening AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, session_date ORDER BY bar_time, arrival) AS rn
    FROM so WHERE bar_time > session_open) WHERE rn = 1)"""


@query(
    sql.with_(
        SESSIONS,
        f"""SELECT symbol, {sql.day_text("session_date")} AS session_date, arrival, bar_time, open
            FROM opening""",
    )
)
def session_open_bar(spark, sf_dir):
    bars = snap.session_open_bars(closed(spark, sf_dir))
    return bars.select("symbol", "session_date", "arrival", "bar_time", "open")


# The retained rows by direct reading of the rule: per symbol, clear points are
# found by looking at every row in order.
RETAINED = f"""{SESSIONS},
policy(symbol, reset, minutes) AS (
  VALUES ('signup', true, NULL), ('error', false, 60), ('view', false, 240), ('click', false, 60),
         ('logout', false, 60)),
steps AS (
  SELECT so.*, reset, minutes,
         session_date IS DISTINCT FROM lag(session_date) OVER w AS turned,
         max(session_open - to_minutes(CAST(coalesce(minutes, 0) AS BIGINT)))
           OVER (PARTITION BY symbol) AS cutoff,
         max(arrival) OVER (PARTITION BY symbol) AS last_arrival
  FROM so JOIN policy USING (symbol) WINDOW w AS (PARTITION BY symbol ORDER BY arrival)),
runs AS (
  SELECT *, max(CASE WHEN turned THEN arrival END) OVER (PARTITION BY symbol) AS run_start
  FROM steps),
cleared AS (
  SELECT *, coalesce(min(CASE WHEN arrival >= run_start AND bar_time > session_open THEN arrival END)
             OVER (PARTITION BY symbol), run_start) AS held_from FROM runs),
held AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY arrival DESC) AS back FROM cleared
    WHERE CASE WHEN reset THEN arrival >= held_from
               ELSE bar_time >= cutoff OR arrival = last_arrival END)
  WHERE back <= 100)"""


@query(
    sql.with_(
        RETAINED,
        f"""SELECT symbol, arrival, bar_time, close, {sql.day_text("session_date")} AS session_date
            FROM held""",
    )
)
def session_retention(spark, sf_dir):
    kept = snap.retained_points(closed_table(spark, sf_dir), policies(spark), default=(False, 60))
    return kept.select("symbol", "arrival", "bar_time", "close", "session_date")


@query(
    sql.with_(
        f"""{RETAINED},
h AS (SELECT symbol, count(*) AS recent_points, min(bar_time) AS oldest_bar_time,
             max(high) AS recent_high, min(low) AS recent_low FROM held GROUP BY symbol),
lst AS (SELECT symbol, arg_max(session_date, arrival) AS sd, max(arrival) AS last_arrival,
               arg_max(bar_time, arrival) AS last_bar_time, arg_max(close, arrival) AS last_close
        FROM so GROUP BY symbol)""",
        f"""SELECT l.symbol, {sql.day_text("l.sd")} AS session_date, last_arrival, last_bar_time,
                   last_close, o.bar_time AS open_bar_time, o.open AS open_price, recent_points,
                   oldest_bar_time, recent_high, recent_low
            FROM lst l LEFT JOIN opening o ON o.symbol = l.symbol AND o.session_date = l.sd
            LEFT JOIN h ON h.symbol = l.symbol""",
    )
)
def snapshot(spark, sf_dir):
    return snap.snapshot(closed_table(spark, sf_dir), policies(spark), default=(False, 60))


@query(
    """WITH s(id, category, role, r, m) AS (
         VALUES ('signup', 'breadth', 'context', NULL, NULL), ('error', 'etf', 'trade', NULL, NULL),
                ('view', 'volatility', 'context', NULL, 240),
                ('click', 'mega_cap', 'context', NULL, NULL),
                ('logout', 'mega_cap', 'context', NULL, NULL))
       SELECT event_type AS symbol, count(*) AS events,
              any_value(coalesce(r, category = 'breadth', false)) AS session_reset,
              CAST(any_value(coalesce(m, CASE WHEN coalesce(category, '') <> 'breadth' THEN 60 END)) AS BIGINT)
                AS pre_market_window_minutes
       FROM events LEFT JOIN s ON s.id = event_type GROUP BY event_type"""
)
def symbol_policies(spark, sf_dir):
    per_symbol = (
        ad.events(spark, sf_dir)
        .groupBy(F.col("event_type").alias("symbol"))
        .agg(F.count("*").alias("events"))
    )
    return snap.with_policy(per_symbol, policies(spark), default=(False, 60))


@query(
    """SELECT event_type AS symbol, count(*) AS events FROM events
       WHERE event_type IN ('error') GROUP BY event_type"""
)
def trade_symbols(spark, sf_dir):
    wanted = sym.with_role(ad.symbols(spark), "trade").withColumnRenamed("id", "event_type")
    traded = ad.events(spark, sf_dir).join(wanted, "event_type", "left_semi")
    return traded.groupBy(F.col("event_type").alias("symbol")).agg(F.count("*").alias("events"))


# --- meaning and quality -----------------------------------------------------


@query(
    sql.with_(
        FR,
        """SELECT symbol, bar_type, bar_interval, count(*) AS rows,
             count(*) FILTER (bar_type <> 2 AND el_ticks <> el_upticks + el_downticks)
               AS ticks_not_up_plus_down,
             count(*) FILTER (bar_type <> 2 AND el_open_interest <> el_downticks) AS interest_not_down,
             count(*) FILTER (bar_type <> 2 AND el_volume <> el_upticks) AS volume_not_up,
             count(*) FILTER (bar_type = 2 AND category = 2 AND el_ticks <> el_volume)
               AS daily_ticks_not_volume,
             count(*) FILTER (bar_type = 2 AND category = 2 AND el_downticks <> 0)
               AS daily_down_not_zero
           FROM pts GROUP BY ALL""",
    )
)
def quality_identities(spark, sf_dir):
    return quality.identity_checks(points(spark, sf_dir))


@query(
    sql.with_(
        FR,
        """SELECT arrival, CASE WHEN category <> 4 THEN bid END AS bid,
                  CASE WHEN category <> 4 THEN ask END AS ask FROM pts""",
    )
)
def index_quote_mask(spark, sf_dir):
    return market.mask_index_quotes(points(spark, sf_dir)).select("arrival", "bid", "ask")


@query(
    sql.with_(
        FR,
        """SELECT symbol, CASE category WHEN 0 THEN 'Future' WHEN 2 THEN 'Stock' WHEN 4 THEN 'Index'
                  WHEN 12 THEN 'Forex' END AS category_name, count(*) AS points
           FROM pts GROUP BY ALL""",
    )
)
def category_names(spark, sf_dir):
    named = points(spark, sf_dir).withColumn("category_name", market.category_name(F.col("category")))
    return named.groupBy("symbol", "category_name").agg(F.count("*").alias("points"))


@query(
    sql.with_(
        FR,
        """SELECT symbol, arrival, bar_time FROM (
             SELECT *, row_number() OVER (PARTITION BY symbol, bar_type, bar_interval
                                          ORDER BY arrival) AS rn FROM pts) WHERE rn <= 3""",
    )
)
def first_points(spark, sf_dir):
    return first_rows(points(spark, sf_dir), CHART, [F.col("arrival")], 3).select(
        "symbol", "arrival", "bar_time"
    )
