"""Registered queries over bars, each with its SQL."""

from __future__ import annotations

from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import functions as F

from barloom.functions import market
from barloom.functions import timeconv as tc
from barloom.operators import completeness as cp
from barloom.operators import impute as imp
from barloom.operators import merge, quality
from barloom.operators.sides import staged
from barloom.plans import adapters as ad
from barloom.plans import sql
from barloom.schemas import BAR_COLUMNS
from barloom.session import shared_dir
from barloom.sources import preview as pv
from barloom.sources import store

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


BAR_LIST = ", ".join(f'"{c}"' for c in BAR_COLUMNS)
INTRADAY_LIST = f'{BAR_LIST}, bartype, "interval", symbol, {sql.day_text("date")} AS date'
DAILY_LIST = f'{BAR_LIST}, bartype, "interval", symbol'
# One bound without zone (Eastern) and one with.
START, END = datetime(2024, 1, 8, 9, 30), datetime(2024, 1, 19, 21, 0, tzinfo=timezone.utc)
RANGE = "bar_time BETWEEN TIMESTAMP '2024-01-08 14:30:00' AND TIMESTAMP '2024-01-19 21:00:00'"


# --- reading -----------------------------------------------------------------


@query(sql.with_(sql.BARS, f"SELECT {INTRADAY_LIST} FROM bars WHERE {RANGE}"))
def load_bars_range(spark, sf_dir):
    return store.in_range(ad.bars(spark, sf_dir), START, END)


@query(sql.with_(sql.BARS, f"SELECT {INTRADAY_LIST} FROM bars WHERE bar_time < TIMESTAMP '1999-01-01'"))
def load_bars_empty(spark, sf_dir):
    return store.in_range(
        ad.bars(spark, sf_dir), datetime(1998, 1, 1), datetime(1998, 12, 31, 18, 0)
    )


@query(
    sql.with_(
        sql.BARS, f"SELECT {INTRADAY_LIST} FROM bars WHERE {RANGE} AND symbol IN ('view', 'click')"
    )
)
def store_load_bars(spark, sf_dir):
    """Write the whole store, then read two symbols of it back."""
    root = f"{shared_dir(spark)}/store-{uuid4().hex}"
    store.append_intraday(ad.bars(spark, sf_dir), root)
    return store.load_bars(spark, root, ["view", "click"], START, END, 1, 60)


@query(sql.with_(sql.DAILY, f"SELECT {DAILY_LIST} FROM daily WHERE {RANGE}"))
def daily_scan(spark, sf_dir):
    return store.in_range(ad.daily_bars(spark, sf_dir), START, END)


@query(sql.with_(sql.BARS, "SELECT DISTINCT symbol FROM bars"))
def symbol_discovery(spark, sf_dir):
    return cp.discovered_symbols(ad.bars(spark, sf_dir), ad.HOURLY)


@query(
    sql.with_(
        sql.BARS,
        f"""SELECT symbol, bartype, "interval", {sql.day_text("date")} AS date, count(*) AS bars
            FROM bars GROUP BY ALL""",
    )
)
def bars_per_day(spark, sf_dir):
    rows = ad.bars(spark, sf_dir).groupBy("symbol", "bartype", "interval", "date")
    return rows.agg(F.count("*").alias("bars"))


@query(
    sql.with_(
        sql.BARS,
        f"""SELECT * FROM (SELECT symbol, {sql.et("bar_time")} AS bar_time, ts, close FROM bars
              ORDER BY ts DESC LIMIT 20)
            UNION ALL
            SELECT * FROM (SELECT symbol, {sql.et("bar_time")} AS bar_time, ts, close FROM bars
              ORDER BY ts LIMIT 10)""",
    )
)
def column_preview(spark, sf_dir):
    return pv.preview(
        ad.bars(spark, sf_dir),
        columns=["symbol", "bar_time", "ts", "close"],
        sort_by="-ts",
        head=20,
        tail=10,
        zone="America/New_York",
    )


# --- time --------------------------------------------------------------------


@query(
    f"""WITH {sql.EVENTS.strip()}, t AS (SELECT event_id, make_timestamp(us) AS t FROM ev),
        d AS (SELECT *, CAST({sql.et("t")} - INTERVAL 4 HOUR AS DATE) AS sd FROM t)
        SELECT event_id, {sql.et("t")} AS wall, {sql.day_text("sd")} AS session_date,
               {sql.utc("sd + INTERVAL 570 MINUTE")} AS session_open,
               {sql.day_text(sql.et("t"))} AS partition_date,
               CAST(epoch(date_trunc('second', {sql.et("t")}) - date_trunc('day', {sql.et("t")}))
                 AS BIGINT) AS tod,
               date_trunc('minute', t) AS minute FROM d"""
)
def session_dates(spark, sf_dir):
    t = F.timestamp_micros("us")
    day = tc.session_date(t)
    return ad.events(spark, sf_dir).select(
        "event_id",
        tc.wall_clock(t).alias("wall"),
        day.alias("session_date"),
        tc.session_open(day).alias("session_open"),
        tc.partition_date(t).alias("partition_date"),
        tc.seconds_of_day(t).alias("tod"),
        tc.floor_minute(t).alias("minute"),
    )


@query(
    sql.with_(
        sql.BARS,
        """SELECT symbol, bar_time FROM bars
           WHERE bar_time_et - date_trunc('day', bar_time_et) > INTERVAL 570 MINUTE
             AND bar_time_et - date_trunc('day', bar_time_et) <= INTERVAL 16 HOUR""",
    )
)
def regular_hours(spark, sf_dir):
    bars = ad.bars(spark, sf_dir)
    return bars.where(tc.in_regular_hours(F.col("bar_time"))).select("symbol", "bar_time")


@query(
    sql.with_(
        sql.BARS, "SELECT symbol, bar_time, bar_time - INTERVAL 1 HOUR AS starts_at FROM bars"
    )
)
def left_edges(spark, sf_dir):
    return ad.bars(spark, sf_dir).select(
        "symbol", "bar_time", tc.left_edge(F.col("bar_time"), F.col("interval")).alias("starts_at")
    )


# --- completeness ------------------------------------------------------------

SLOTS = sql.SLOTS


def stored_bars(spark, sf_dir):
    """Hourly bars as a table, as a store would hold them."""
    return staged(ad.bars(spark, sf_dir), "bars")


def slots(spark, sf_dir, bars=None):
    bars = bars or stored_bars(spark, sf_dir)
    return cp.reconcile(bars, cp.profile(bars, ad.HOURLY), ad.HOURLY)


def report(spark, sf_dir):
    return cp.day_report(stored_bars(spark, sf_dir), ad.HOURLY)


@query(sql.with_(SLOTS, "SELECT symbol, tod, days_seen, reference_days FROM prof"))
def learned_profile(spark, sf_dir):
    return cp.profile(stored_bars(spark, sf_dir), ad.HOURLY)


@query(
    sql.with_(
        SLOTS,
        """SELECT symbol, coalesce(reference_days, 0) AS reference_days
           FROM (SELECT DISTINCT symbol FROM bars) LEFT JOIN ref USING (symbol)
           WHERE coalesce(reference_days, 0) < 22""",
    )
)
def thin_symbols(spark, sf_dir):
    from dataclasses import replace

    # 21 due days exist, so asking for 22 leaves no symbol a profile.
    return cp.thin_symbols(stored_bars(spark, sf_dir), replace(ad.HOURLY, min_reference_days=22))


@query(
    sql.with_(SLOTS, f"SELECT symbol, {sql.day_text('date')} AS date, bar_time FROM expd")
)
def expected_bars(spark, sf_dir):
    return cp.expected_bars(cp.profile(stored_bars(spark, sf_dir), ad.HOURLY), ad.HOURLY)


@query(
    sql.with_(SLOTS, f"SELECT symbol, {sql.day_text('date')} AS date, bar_time FROM missing")
)
def missing_bars(spark, sf_dir):
    return cp.missing_bars(slots(spark, sf_dir))


@query(sql.with_(SLOTS, f"SELECT symbol, {sql.day_text('date')} AS date, extra FROM extra"))
def extra_bars(spark, sf_dir):
    bars = stored_bars(spark, sf_dir)
    trusted = cp.reference_days(bars, ad.HOURLY).where("trusted")
    return cp.extra_bars(slots(spark, sf_dir, bars), trusted)


REPORT_LIST = (
    f"symbol, {sql.day_text('date')} AS date, status, rows, expected, missing, extra FROM report"
)


@query(sql.with_(SLOTS, f"SELECT {REPORT_LIST}"))
def day_status(spark, sf_dir):
    return report(spark, sf_dir)


@query(
    sql.with_(
        SLOTS, f"SELECT symbol, {sql.day_text('date')} AS date, gap_start, gap_end, bars FROM gaps"
    )
)
def gap_runs(spark, sf_dir):
    return cp.gap_runs(slots(spark, sf_dir))


@query(
    sql.with_(
        f"""{SLOTS},
g AS (
  SELECT symbol, date, row_number() OVER (PARTITION BY symbol, date ORDER BY gap_start) AS i,
         count(*) OVER (PARTITION BY symbol, date) AS runs,
         strftime({sql.et("gap_start")}, '%H:%M') ||
           CASE WHEN gap_start = gap_end THEN '' ELSE '-' || strftime({sql.et("gap_end")}, '%H:%M') END
           || ' (' || bars || ')' AS text FROM gaps)""",
        f"""SELECT symbol, {sql.day_text("date")} AS date, any_value(runs) AS runs,
              string_agg(text, ', ' ORDER BY i) FILTER (i <= 3) ||
              CASE WHEN any_value(runs) > 3 THEN ', +' || (any_value(runs) - 3) || ' more' ELSE '' END
              AS gaps FROM g GROUP BY symbol, date""",
    )
)
def gap_text(spark, sf_dir):
    return cp.gap_text(cp.gap_runs(slots(spark, sf_dir)))


@query(sql.with_(SLOTS, "SELECT * FROM counts"))
def completeness_counts(spark, sf_dir):
    return cp.symbol_counts(report(spark, sf_dir))


@query(
    sql.with_(
        SLOTS,
        """SELECT *, CASE WHEN incomplete + file_missing + unreadable = 0 THEN 'clean'
             WHEN file_missing = ok + incomplete + file_missing THEN 'ALL_MISSING'
             WHEN file_missing > 0 AND incomplete = 0 THEN file_missing || 'd gap'
             WHEN incomplete > 0 AND file_missing = 0 THEN incomplete || 'd incomplete'
             ELSE file_missing || 'd gap + ' || incomplete || 'd incomplete' END AS verdict
           FROM counts""",
    )
)
def completeness_summary(spark, sf_dir):
    return cp.cross_summary(cp.symbol_counts(report(spark, sf_dir)))


@query(
    sql.with_(
        SLOTS,
        """SELECT CAST(coalesce(sum(incomplete + file_missing + unreadable), 0) + (
                    SELECT count(*) FROM (SELECT DISTINCT symbol FROM bars)
                    WHERE symbol NOT IN (SELECT symbol FROM counts)) AS BIGINT) AS overall_bad,
                  CAST(coalesce(sum(total_missing), 0) AS BIGINT) AS overall_missing FROM counts""",
    )
)
def completeness_totals(spark, sf_dir):
    bars = stored_bars(spark, sf_dir)
    counts = cp.symbol_counts(cp.day_report(bars, ad.HOURLY))
    return cp.totals(counts, cp.thin_symbols(bars, ad.HOURLY))


# --- imputation --------------------------------------------------------------


def _impute_sql(value: str, note: str) -> str:
    columns = ", ".join(f'"{c}"' for c in BAR_COLUMNS)
    return sql.with_(
        f"""{SLOTS},
gap AS (
  SELECT m.symbol, m.date, m.bar_time,
         (SELECT max(b.bar_time) FROM due b WHERE b.symbol = m.symbol AND b.date = m.date
            AND b.bar_time < m.bar_time) AS pt,
         (SELECT min(b.bar_time) FROM due b WHERE b.symbol = m.symbol AND b.date = m.date
            AND b.bar_time > m.bar_time) AS nt FROM missing m),
nb AS (
  SELECT g.*, p.close AS pv, n.open AS nv, coalesce(p.category, n.category) AS category
  FROM gap g LEFT JOIN due p ON p.symbol = g.symbol AND p.bar_time = g.pt
             LEFT JOIN due n ON n.symbol = g.symbol AND n.bar_time = g.nt
  WHERE g.pt IS NOT NULL OR g.nt IS NOT NULL),
filled AS (SELECT *, {value} AS v, {note} AS note FROM nb)""",
        f"""SELECT {columns}, false AS imputed, bartype, "interval", symbol,
                   {sql.day_text("date")} AS date
            FROM due WHERE symbol IN (SELECT symbol FROM ref WHERE reference_days >= 5)
            UNION ALL
            SELECT bar_time, {sql.et("bar_time")}, v, v, v, v, 0, 0, 0, 0, 0, category, NULL, NULL,
                   NULL, true, 1, 60, symbol, {sql.day_text("date")} FROM filled""",
    )


@query(_impute_sql("coalesce(pv, nv)", "1"))
def impute_ffill(spark, sf_dir):
    return imp.impute(stored_bars(spark, sf_dir), ad.HOURLY, "ffill")


@query(_impute_sql("coalesce(nv, pv)", "1"))
def impute_bfill(spark, sf_dir):
    return imp.impute(stored_bars(spark, sf_dir), ad.HOURLY, "bfill")


@query(
    _impute_sql(
        """coalesce(pv + (epoch_us(bar_time) - epoch_us(pt)) / (epoch_us(nt) - epoch_us(pt))
                    * (nv - pv), pv, nv)""",
        "1",
    )
)
def impute_interpolate(spark, sf_dir):
    return imp.impute(stored_bars(spark, sf_dir), ad.HOURLY, "interpolate")


@query(
    sql.with_(
        SLOTS,
        """SELECT symbol, count(*) FILTER (status = 'INCOMPLETE') AS files_touched,
             CAST(coalesce(sum(missing) FILTER (status = 'INCOMPLETE'), 0) AS BIGINT) AS rows_imputed,
             CAST(0 AS BIGINT) AS rows_skipped, count(*) FILTER (status = 'OK') AS already_ok,
             count(*) FILTER (status = 'FILE_MISSING') AS file_missing,
             count(*) FILTER (status = 'HOLIDAY') AS holiday,
             count(*) FILTER (status = 'WEEKEND') AS weekend FROM report GROUP BY symbol""",
    )
)
def impute_report(spark, sf_dir):
    return imp.report(stored_bars(spark, sf_dir), ad.HOURLY, "ffill")


# --- repeats -----------------------------------------------------------------

REPEATED = f"""{sql.EVENTS},
rep0 AS (
  SELECT event_id AS landing, CAST(CASE WHEN user_id < 30 THEN 0 ELSE 1 END AS BIGINT) AS bartype,
         CAST(60 AS BIGINT) AS "interval", event_type AS symbol,
         make_timestamp((us // 3600000000 + 1) * 3600000000) AS bar_time, value AS close FROM ev),
rep AS (SELECT *, CAST({sql.et("bar_time")} AS DATE) AS date FROM rep0)"""


@query(
    sql.with_(
        REPEATED,
        f"""SELECT landing, bartype, "interval", symbol, bar_time, close,
                   {sql.day_text("date")} AS date FROM (
              SELECT *, row_number() OVER (PARTITION BY bartype, "interval", symbol, date, bar_time
                                           ORDER BY landing) AS rn FROM rep)
            WHERE rn = 1 OR bartype = 0""",
    )
)
def dedupe_first(spark, sf_dir):
    return merge.keep_first(ad.repeated_bars(spark, sf_dir), [F.col("landing")])


@query(
    sql.with_(
        f"""{REPEATED},
r AS (SELECT bartype, "interval", symbol, date, count(*) AS b,
             CASE WHEN any_value(bartype) = 0 THEN count(*) ELSE count(DISTINCT bar_time) END AS a
      FROM rep GROUP BY ALL)""",
        """SELECT count(*) AS files_scanned, count(*) FILTER (b > a) AS files_touched,
             CAST(coalesce(sum(b) FILTER (bartype <> 0), 0) AS BIGINT) AS rows_before,
             CAST(coalesce(sum(a) FILTER (bartype <> 0), 0) AS BIGINT) AS rows_after,
             CAST(sum(b - a) AS BIGINT) AS rows_removed,
             count(*) FILTER (bartype = 0) AS tick_files_skipped FROM r""",
    )
)
def dedupe_totals(spark, sf_dir):
    return merge.dedupe_totals(merge.dedupe_report(ad.repeated_bars(spark, sf_dir)))


@query(
    sql.with_(
        f"{sql.EVENTS},{sql.daily('old', 'value < 20')},{sql.daily('new', 'value >= 20')}",
        f"""SELECT {DAILY_LIST} FROM new UNION ALL SELECT {DAILY_LIST} FROM old
            WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.symbol = old.symbol
                              AND new.bar_time = old.bar_time)""",
    )
)
def daily_merge_last(spark, sf_dir):
    stored = ad.daily_bars(spark, sf_dir, F.col("value") < 20)
    incoming = ad.daily_bars(spark, sf_dir, F.col("value") >= 20)
    return merge.merge_last(stored, incoming, "ts", ["bartype", "interval", "symbol"])


@query(
    sql.with_(
        sql.DAILY,
        """SELECT symbol, bartype AS bar_type, "interval" AS bar_interval, count(*) AS rows,
                  CAST(0 AS BIGINT) AS ticks_not_up_plus_down, CAST(0 AS BIGINT) AS interest_not_down,
                  CAST(0 AS BIGINT) AS volume_not_up,
                  count(*) FILTER (category = 2 AND el_ticks <> el_volume) AS daily_ticks_not_volume,
                  count(*) FILTER (category = 2 AND el_downticks <> 0) AS daily_down_not_zero
           FROM daily GROUP BY ALL""",
    )
)
def daily_identities(spark, sf_dir):
    names = {"bartype": "bar_type", "interval": "bar_interval"}
    return quality.identity_checks(ad.daily_bars(spark, sf_dir).withColumnsRenamed(names))


# --- meaning -----------------------------------------------------------------


@query(
    sql.with_(
        f"{sql.EVENTS},{sql.bars()},{sql.daily()}",
        """SELECT symbol, bartype, bar_time, el_ticks AS total_volume, el_upticks AS up_volume,
                  el_downticks AS down_volume, CAST(NULL AS BIGINT) AS open_interest FROM bars
           UNION ALL
           SELECT symbol, bartype, bar_time, el_volume, NULL, NULL, el_open_interest FROM daily""",
    )
)
def quantity_view(spark, sf_dir):
    both = ad.bars(spark, sf_dir).drop("date").unionByName(ad.daily_bars(spark, sf_dir))
    return market.with_quantity_meaning(both).select(
        "symbol", "bartype", "bar_time", "total_volume", "up_volume", "down_volume", "open_interest"
    )


@query(
    sql.with_(
        f"{sql.EVENTS},{sql.bars()},{sql.daily()}",
        """SELECT symbol, bartype, CAST(nullif(sum(el_ticks), 0) AS BIGINT) AS total_volume,
                  round(sum(close * el_ticks) / nullif(sum(el_ticks), 0), 6) AS vwap,
                  CAST(NULL AS BIGINT) AS open_interest FROM bars GROUP BY symbol, bartype
           UNION ALL
           SELECT symbol, bartype, CAST(nullif(sum(el_volume), 0) AS BIGINT),
                  round(sum(close * el_volume) / nullif(sum(el_volume), 0), 6),
                  CAST(sum(el_open_interest) AS BIGINT) FROM daily GROUP BY symbol, bartype""",
    )
)
def volume_by_regime(spark, sf_dir):
    both = ad.bars(spark, sf_dir).drop("date").unionByName(ad.daily_bars(spark, sf_dir))
    return (
        quality.total_volume(both)
        .withColumn("vwap", F.round("vwap", 6))
        .select("symbol", "bartype", "total_volume", "vwap", "open_interest")
    )


@query(
    sql.with_(
        f"{sql.EVENTS},{sql.bars()},{sql.daily()}",
        f"""SELECT d.symbol, {sql.day_text("d.bar_time_et")} AS date, d.el_volume AS daily_volume,
                   CAST(sum(b.el_ticks) AS BIGINT) AS intraday_total,
                   CAST(sum(b.el_volume) AS BIGINT) AS intraday_up,
                   CAST(d.el_volume AS DOUBLE) / nullif(sum(b.el_ticks), 0) AS ratio
            FROM daily d JOIN bars b ON b.symbol = d.symbol
              AND b.date = CAST(d.bar_time_et AS DATE)
            GROUP BY d.symbol, d.bar_time_et, d.el_volume""",
    )
)
def daily_vs_intraday(spark, sf_dir):
    return quality.daily_against_intraday(ad.daily_bars(spark, sf_dir), ad.bars(spark, sf_dir))
