from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from feed import collect, points

from barloom.operators import completeness as cp
from barloom.operators import impute as imp
from barloom.sources import store

ET = ZoneInfo("America/New_York")
# A 60-minute chart restarts at the open and the close of regular hours.
CLOSES = [
    time(7), time(8), time(9), time(9, 30), time(10, 30), time(11, 30), time(12, 30), time(13, 30),
    time(14, 30), time(15, 30), time(16), time(17), time(18), time(19), time(20),
]
FIRST = date(2026, 4, 6)


def weekdays(n):
    days, d = [], FIRST
    while len(days) < n:
        if d.weekday() < 5:
            days.append(d)
        d += timedelta(days=1)
    return days


def at(day, clock):
    return datetime.combine(day, clock, tzinfo=ET).astimezone(timezone.utc)


def stored(spark, stamps, symbol="SPY"):
    rows = [
        {"symbol": symbol, "bar_interval": 60, "bar_time": s, "open": float(i), "close": i + 0.5, "ts": float(i)}
        for i, s in enumerate(stamps)
    ]
    return store.as_bars(points(spark, rows))


def sessions(days, drop=(), extra=()):
    full = [at(d, c) for d in days for c in CLOSES]
    return [s for s in full if s not in drop] + list(extra)


def scope(days, **changes):
    base = {"start": FIRST, "end": FIRST + timedelta(days=days), "start_time": time(6), "end_time": time(20)}
    return cp.Scope(**{**base, "bar_interval": 60, **changes})


def test_profile_has_the_stubs_of_the_session(spark):
    got = cp.profile(stored(spark, sessions(weekdays(10))), scope(11)).orderBy("tod")
    assert [r[0] for r in collect(got, "tod")] == [c.hour * 3600 + c.minute * 60 for c in CLOSES]


def test_one_odd_day_does_not_teach_a_time(spark):
    odd = sessions(weekdays(10), extra=[at(weekdays(10)[3], time(19, 45))])
    assert cp.profile(stored(spark, odd), scope(11)).count() == 15


def test_the_window_is_open_at_its_start(spark):
    narrow = scope(11, start_time=time(9, 30), end_time=time(16))
    got = cp.profile(stored(spark, sessions(weekdays(10))), narrow)
    assert collect(got.agg({"tod": "min"}), "min(tod)") == [(10 * 3600 + 1800,)]


def test_too_few_days_give_no_profile(spark):
    bars = stored(spark, sessions(weekdays(2)))
    assert cp.profile(bars, scope(11)).count() == 0
    assert collect(cp.thin_symbols(bars, scope(11)), "symbol", "reference_days") == [("SPY", 2)]
    counts = cp.symbol_counts(cp.day_report(bars, scope(11)))
    assert tuple(cp.totals(counts, cp.thin_symbols(bars, scope(11))).first()) == (1, 0)


def test_statuses_and_summary(spark):
    days = weekdays(10)
    missing = [at(days[9], time(20))]
    bars = stored(spark, sessions(days, drop=missing, extra=[at(days[0], time(5))]))
    unreadable = spark.createDataFrame([("SPY", date(2026, 4, 21))], "symbol string, date date")
    window = scope(17, holidays=(date(2026, 4, 22), date(2026, 4, 18)))
    report = cp.day_report(bars, window, unreadable).orderBy("date").collect()
    by_day = {r["date"]: tuple(r)[2:] for r in report}
    assert by_day[days[0]] == ("OK", 16, 15, 0, 1)
    assert by_day[days[9]] == ("INCOMPLETE", 14, 15, 1, 0)
    assert by_day[date(2026, 4, 18)][0] == "WEEKEND"
    assert by_day[date(2026, 4, 20)] == ("FILE_MISSING", 0, 15, 15, 0)
    assert by_day[date(2026, 4, 21)] == ("UNREADABLE", 0, 15, 0, 0)
    assert by_day[date(2026, 4, 22)] == ("HOLIDAY", 0, 0, 0, 0)
    counts = cp.symbol_counts(cp.day_report(bars, window, unreadable))
    row = cp.cross_summary(counts).first()
    assert (row["ok"], row["weekend"], row["total_missing"]) == (9, 4, 31)
    assert row["verdict"] == "2d gap + 1d incomplete" if row["file_missing"] == 2 else "1d gap + 1d incomplete"


def test_verdicts(spark):
    columns = "symbol string, ok bigint, incomplete bigint, file_missing bigint, unreadable bigint"
    rows = [("a", 3, 0, 0, 0), ("b", 0, 0, 4, 0), ("c", 2, 0, 1, 0), ("d", 2, 5, 0, 1), ("e", 0, 0, 0, 2), ("f", 1, 2, 3, 0)]
    got = cp.cross_summary(spark.createDataFrame(rows, columns)).orderBy("symbol")
    assert [r[0] for r in collect(got, "verdict")] == [
        "clean", "ALL_MISSING", "1d gap", "5d incomplete", "ALL_MISSING", "3d gap + 2d incomplete",
    ]


def test_gap_runs_follow_the_expected_series(spark):
    days = weekdays(10)
    drop = [at(days[4], c) for c in (time(9), time(9, 30), time(10, 30), time(15, 30), time(16), time(18))]
    drop += [at(days[5], c) for c in CLOSES[::2]]
    bars = stored(spark, sessions(days, drop=drop))
    runs = cp.gap_runs(cp.reconcile(bars, cp.profile(bars, scope(11)), scope(11)))
    text = dict(collect(cp.gap_text(runs), "date", "gaps"))
    assert text[days[4]] == "09:00-10:30 (3), 15:30-16:00 (2), 18:00 (1)"
    assert text[days[5]] == "07:00 (1), 09:00 (1), 10:30 (1), +5 more"


def test_daylight_saving_keeps_the_times_of_day(spark):
    days = [date(2026, 3, d) for d in (2, 3, 4, 5, 6, 9, 10, 11, 12, 13)]
    bars = stored(spark, sessions(days))
    window = scope(0, start=days[0], end=days[-1])
    assert {r["status"] for r in cp.day_report(bars, window).collect()} == {"OK", "WEEKEND"}


def test_refused_scopes():
    for bad in ({"bar_type": 2}, {"bar_interval": 0}, {"end": date(2026, 1, 1)}, {"end_time": time(5)}):
        with pytest.raises(ValueError):
            scope(11, **bad)


def imputed(spark, drop, method):
    bars = stored(spark, sessions(weekdays(10), drop=drop))
    return bars, imp.impute(bars, scope(11), method)


def neighbours_by_loop(bars, t):
    day = [r for r in bars.collect() if r["date"] == t.astimezone(ET).date()]
    before = [r for r in day if r["bar_time"] < t.replace(tzinfo=None)]
    after = [r for r in day if r["bar_time"] > t.replace(tzinfo=None)]
    prev = max(before, key=lambda r: r["bar_time"]) if before else None
    return prev, min(after, key=lambda r: r["bar_time"]) if after else None


@pytest.mark.parametrize("method", imp.METHODS)
def test_imputed_values_equal_loop(spark, method):
    day = weekdays(10)[6]
    drop = [at(day, c) for c in (CLOSES[0], CLOSES[3], CLOSES[4], CLOSES[14])]
    bars, copy = imputed(spark, drop, method)
    assert copy.count() == 150 and copy.where("NOT imputed").count() == 146
    invented = {r["bar_time"]: r for r in copy.where("imputed").collect()}
    assert len(invented) == 4
    for t in drop:
        prev, nxt = neighbours_by_loop(bars, t)
        row = invented[t.replace(tzinfo=None)]
        pair = (prev["close"] if prev else None, nxt["open"] if nxt else None)
        if method == "interpolate" and None not in pair:
            span = (nxt["bar_time"] - prev["bar_time"]).total_seconds()
            share = (t.replace(tzinfo=None) - prev["bar_time"]).total_seconds() / span
            want = pair[0] + share * (pair[1] - pair[0])
        else:
            first, second = pair if method != "bfill" else pair[::-1]
            want = first if first is not None else second
        assert {row["open"], row["high"], row["low"], row["close"]} == {want}
        assert (row["el_ticks"], row["bid"], row["ts"], row["category"]) == (0, None, None, 2)


def test_imputation_report_and_missing_files(spark):
    days = weekdays(10)
    drop = [at(days[2], CLOSES[5]), *[at(days[8], c) for c in CLOSES]]
    bars, copy = imputed(spark, drop, "ffill")
    assert copy.where("imputed").count() == 1
    row = imp.report(bars, scope(11), "ffill").first()
    assert tuple(row)[1:] == (1, 1, 0, 8, 1, 0, 2)
    assert tuple(imp.overall(imp.report(bars, scope(11), "ffill")).first()) == (1, 1, 0)
    with pytest.raises(ValueError):
        imp.report(bars, scope(11), "guess")


def test_repeated_neighbours_use_the_last_before_and_the_first_after(spark):
    days = weekdays(10)
    gap = at(days[1], CLOSES[5])
    twice = [at(days[1], CLOSES[4]), at(days[1], CLOSES[6])]
    bars = stored(spark, sessions(days, drop=[gap], extra=twice))
    prev_close = max(r["close"] for r in bars.collect() if r["bar_time"] == twice[0].replace(tzinfo=None))
    next_open = min(r["open"] for r in bars.collect() if r["bar_time"] == twice[1].replace(tzinfo=None))
    assert collect(imp.invented_bars(bars, scope(11), "ffill"), "open", "note") == [(prev_close, "ffill")]
    assert collect(imp.invented_bars(bars, scope(11), "bfill"), "open") == [(next_open,)]
