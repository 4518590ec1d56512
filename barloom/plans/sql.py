"""Building blocks of the comparison SQL: the adapters, written for DuckDB."""

from __future__ import annotations


def et(instant: str) -> str:
    return f"timezone('America/New_York', timezone('UTC', {instant}))"


def utc(wall: str) -> str:
    return f"timezone('UTC', timezone('America/New_York', {wall}))"


def day_text(day: str) -> str:
    return f"strftime(CAST({day} AS DATE), '%Y-%m-%d')"


CATEGORY = (
    "CAST(CASE {0} WHEN 'signup' THEN 2 WHEN 'error' THEN 4 WHEN 'view' THEN 2 "
    "WHEN 'click' THEN 0 WHEN 'purchase' THEN 12 END AS BIGINT)"
)

EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS cents, epoch_us(ts) AS us
  FROM events)"""

FRAMES = f"""{EVENTS},
fr0 AS (
  SELECT *, us - cents * 10000 AS stamp_us,
         CAST(CASE WHEN user_id < 30 THEN 0 ELSE 1 END AS BIGINT) AS bar_type,
         CAST(CASE WHEN user_id < 4 THEN 5 WHEN user_id < 30 THEN 1 WHEN user_id < 90 THEN 60 ELSE 15 END AS BIGINT)
           AS bar_interval
  FROM ev),
fr AS (
  SELECT event_id AS arrival,
         CASE WHEN k IN (13, 15, 18) THEN '__ts2py__' WHEN k = 12 THEN event_type || 'G'
              ELSE event_type END AS topic,
         event_type, k, user_id, value, us, stamp_us, bar_type, bar_interval,
         make_timestamp(CASE WHEN bar_type = 0 THEN stamp_us ELSE
           (stamp_us // (bar_interval * CAST(60000000 AS BIGINT)) + 1) * bar_interval * CAST(60000000 AS BIGINT) END) AS label,
         stamp_us // 60000000 - 28400000 AS minute_no,
         epoch_us(date_trunc('week', make_timestamp(us))) AS sid,
         us + k * 1000 + user_id * 7 AS landed_us,
         {CATEGORY.format("event_type")} AS category
  FROM fr0),
sub AS (
  SELECT * FROM fr
  WHERE topic IN ('signup', 'error', 'view', 'click', 'logout', '__ts2py__')),
pts AS (
  SELECT arrival, topic AS symbol,
         date_trunc('minute', CASE WHEN k = 5 THEN make_timestamp(us) ELSE label END) AS bar_time,
         bar_type, bar_interval, category,
         value AS open, value + k * CAST(0.01 AS DOUBLE) AS high,
         value - k * CAST(0.01 AS DOUBLE) AS low, value AS close,
         CASE WHEN k = 16 THEN 10000000000000000
              ELSE k + CASE WHEN user_id > 140 THEN 1 ELSE 0 END END AS el_volume,
         k + user_id AS el_ticks, k AS el_upticks, user_id AS el_downticks,
         user_id + CASE WHEN k > 50 THEN 1 ELSE 0 END AS el_open_interest,
         CASE WHEN k <> 10 AND value - CAST(0.01 AS DOUBLE) > 0
              THEN value - CAST(0.01 AS DOUBLE) END AS bid,
         CASE WHEN k <> 10 THEN value + CAST(0.01 AS DOUBLE) END AS ask,
         us / 1e6 AS ts, k = 5 AS time_from_receive_clock
  FROM sub
  WHERE topic <> '__ts2py__' AND k NOT IN (0, 1, 2, 3, 4, 6, 7, 11, 14)),
obs AS (
  SELECT arrival, sid, topic, minute_no AS seq FROM sub WHERE k NOT IN (0, 1, 3, 11, 14, 17)),
hellos AS (
  SELECT arrival, event_type AS symbol, bar_type, bar_interval, category
  FROM sub WHERE topic = '__ts2py__' AND k = 13)"""

SEQ_STEPS = """
seq_steps AS (
  SELECT *, max(seq) OVER (PARTITION BY sid, topic ORDER BY arrival
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 AS expected FROM obs)"""

KEPT = """
marked AS (
  SELECT *, coalesce(bar_time < max(bar_time) OVER (
           PARTITION BY symbol, bar_type, bar_interval ORDER BY arrival
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stale
  FROM pts WHERE bar_type <> 0),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, bar_type, bar_interval, bar_time
                               ORDER BY arrival DESC) AS back,
         lag(high) OVER (PARTITION BY symbol, bar_type, bar_interval, bar_time
                         ORDER BY arrival) AS high_before,
         lag(low) OVER (PARTITION BY symbol, bar_type, bar_interval, bar_time
                        ORDER BY arrival) AS low_before
  FROM marked WHERE NOT stale),
closed AS (
  SELECT * EXCLUDE (stale, back, high_before, low_before) FROM kept WHERE back = 1
  UNION ALL BY NAME SELECT * FROM pts WHERE bar_type = 0)"""


def bars(minutes: int = 60, name: str = "bars") -> str:
    step = minutes * 60_000_000
    return f"""
{name}0 AS (
  SELECT event_type AS symbol, us // {step} AS bucket,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close,
         CAST(coalesce(sum(k) FILTER (value >= 20), 0) AS BIGINT) AS ups,
         CAST(coalesce(sum(k) FILTER (value < 20), 0) AS BIGINT) AS downs,
         CAST(sum(k) AS BIGINT) AS el_ticks,
         count(*) FILTER (user_id > 140) AS u140, count(*) FILTER (value > 200) AS v200,
         max(us) AS last_us
  FROM ev GROUP BY ALL),
{name} AS (
  SELECT make_timestamp((bucket + 1) * {step}) AS bar_time,
         {et(f"make_timestamp((bucket + 1) * {step})")} AS bar_time_et,
         open, high, low, close, ups + u140 AS el_volume, el_ticks, ups AS el_upticks,
         downs AS el_downticks, downs + v200 AS el_open_interest,
         {CATEGORY.format("symbol")} AS category,
         CASE WHEN close >= 5 THEN close - CAST(0.01 AS DOUBLE) END AS bid,
         close + CAST(0.01 AS DOUBLE) AS ask, last_us / 1e6 AS ts,
         CAST(1 AS BIGINT) AS bartype, CAST({minutes} AS BIGINT) AS "interval", symbol,
         CAST({et(f"make_timestamp((bucket + 1) * {step})")} AS DATE) AS date
  FROM {name}0)"""


def daily(name: str = "daily", where: str = "true") -> str:
    return f"""
{name}0 AS (
  SELECT event_type AS symbol, CAST({et("make_timestamp(us)")} AS DATE) AS day,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close,
         CAST(coalesce(sum(k) FILTER (value >= 20), 0) AS BIGINT) AS ups,
         CAST(coalesce(sum(k) FILTER (value < 20), 0) AS BIGINT) AS downs,
         CAST(sum(k) AS BIGINT) AS el_ticks,
         count(*) FILTER (user_id > 140) AS u140, count(*) FILTER (value > 200) AS v200,
         max(us) AS last_us
  FROM ev WHERE {where} GROUP BY ALL),
{name} AS (
  SELECT {utc("day + INTERVAL 16 HOUR")} AS bar_time, day + INTERVAL 16 HOUR AS bar_time_et,
         open, high, low, close, ups + u140 AS el_volume, el_ticks, ups AS el_upticks,
         downs AS el_downticks, downs + v200 AS el_open_interest,
         {CATEGORY.format("symbol")} AS category,
         CASE WHEN close >= 5 THEN close - CAST(0.01 AS DOUBLE) END AS bid,
         close + CAST(0.01 AS DOUBLE) AS ask, last_us / 1e6 AS ts,
         CAST(2 AS BIGINT) AS bartype, CAST(1 AS BIGINT) AS "interval", symbol
  FROM {name}0)"""


BARS = f"{EVENTS},{bars()}"
DAILY = f"{EVENTS},{daily()}"

# Completeness over hourly bars: January 2024, 06:00-20:00 Eastern, one holiday.
SLOTS = f"""{BARS},
due AS (
  SELECT * FROM bars
  WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' AND isodow(date) < 6
    AND date <> DATE '2024-01-15'),
times AS (
  SELECT DISTINCT symbol, date, epoch(bar_time_et - date_trunc('day', bar_time_et))::BIGINT AS tod
  FROM due WHERE bar_time_et - date_trunc('day', bar_time_et) > INTERVAL 6 HOUR
             AND bar_time_et - date_trunc('day', bar_time_et) <= INTERVAL 20 HOUR),
ref AS (SELECT symbol, count(DISTINCT date) AS reference_days FROM times GROUP BY symbol),
prof AS (
  SELECT symbol, tod, count(*) AS days_seen, any_value(reference_days) AS reference_days
  FROM times JOIN ref USING (symbol) WHERE reference_days >= 5
  GROUP BY symbol, tod HAVING 2 * count(*) > any_value(reference_days)),
cal AS (
  SELECT CAST(d AS DATE) AS date, isodow(d) > 5 AS weekend, d = DATE '2024-01-15' AS holiday
  FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS d)),
expd AS (
  SELECT symbol, date, {utc("date + to_seconds(tod)")} AS bar_time,
         row_number() OVER (PARTITION BY symbol, date ORDER BY tod) AS pos
  FROM prof, cal WHERE NOT weekend AND NOT holiday),
missing AS (
  SELECT e.* FROM expd e ANTI JOIN due b
    ON e.symbol = b.symbol AND e.date = b.date AND e.bar_time = b.bar_time),
extra AS (
  SELECT symbol, date, count(DISTINCT bar_time) AS extra
  FROM due b WHERE symbol IN (SELECT symbol FROM ref WHERE reference_days >= 5)
    AND NOT EXISTS (SELECT 1 FROM expd e WHERE e.symbol = b.symbol AND e.date = b.date
                    AND e.bar_time = b.bar_time)
  GROUP BY ALL),
report AS (
  SELECT symbol, date,
         CASE WHEN weekend THEN 'WEEKEND' WHEN holiday THEN 'HOLIDAY'
              WHEN coalesce(n, 0) = 0 THEN 'FILE_MISSING'
              WHEN coalesce(m, 0) > 0 THEN 'INCOMPLETE' ELSE 'OK' END AS status,
         CASE WHEN weekend OR holiday THEN 0 ELSE coalesce(n, 0) END AS rows,
         CASE WHEN weekend OR holiday THEN 0 ELSE coalesce(size, 0) END AS expected,
         CASE WHEN weekend OR holiday THEN 0 WHEN coalesce(n, 0) = 0 THEN coalesce(size, 0)
              ELSE coalesce(m, 0) END AS missing,
         CASE WHEN weekend OR holiday THEN 0 ELSE coalesce(extra, 0) END AS extra
  FROM (SELECT symbol FROM ref WHERE reference_days >= 5) CROSS JOIN cal
  LEFT JOIN (SELECT symbol, date, count(*) AS n FROM due GROUP BY ALL) USING (symbol, date)
  LEFT JOIN (SELECT symbol, date, count(*) AS m FROM missing GROUP BY ALL) USING (symbol, date)
  LEFT JOIN extra USING (symbol, date)
  LEFT JOIN (SELECT symbol, count(*) AS size FROM prof GROUP BY symbol) USING (symbol)),
gaps AS (
  SELECT symbol, date, min(bar_time) AS gap_start, max(bar_time) AS gap_end, count(*) AS bars
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY symbol, date ORDER BY pos) AS island
        FROM missing)
  GROUP BY symbol, date, island),
counts AS (
  SELECT symbol, count(*) FILTER (status = 'OK') AS ok,
         count(*) FILTER (status = 'INCOMPLETE') AS incomplete,
         count(*) FILTER (status = 'FILE_MISSING') AS file_missing,
         count(*) FILTER (status = 'UNREADABLE') AS unreadable,
         count(*) FILTER (status = 'HOLIDAY') AS holiday,
         count(*) FILTER (status = 'WEEKEND') AS weekend,
         CAST(sum(missing) AS BIGINT) AS total_missing
  FROM report GROUP BY symbol)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"
