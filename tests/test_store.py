from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from feed import collect, minute, points, utc_text
from pyspark.sql import functions as F

from barloom.operators import merge
from barloom.schemas import BAR_COLUMNS, QUANTITIES
from barloom.sources import preview, store

START, END = datetime(2026, 4, 20, 9, 31), datetime(2026, 4, 20, 9, 33)


def bars(spark, rows):
    return store.as_bars(points(spark, rows))


def two_symbols(spark):
    rows = []
    for symbol in ("SPY", "$TICK", "BRK.B", "007", "A=B/C"):
        for n in (0, 1, 2, 3, 60 * 24):
            v = 1000 + n
            rows.append(
                {
                    "symbol": symbol, "bar_time": minute(n), "el_volume": v, "el_ticks": 2 * v + 7,
                    "el_upticks": v + 3, "el_downticks": v + 5, "el_open_interest": 0,
                }
            )
    return bars(spark, rows)


def test_round_trip_bounds_and_schema(spark, folder):
    store.append_intraday(two_symbols(spark), folder)
    for symbol in ("SPY", "$TICK", "BRK.B", "007", "A=B/C"):
        got = store.load_bars(spark, folder, symbol, START, END, 1, 1)
        assert collect(got, utc_text("bar_time"), "symbol") == [
            (f"2026-04-20 13:3{n}:00", symbol) for n in (1, 2, 3)
        ]
    row = got.first()
    assert [row[q] for q in QUANTITIES] == [1001, 2009, 1004, 1006, 0]
    assert row["bar_time_et"] == datetime(2026, 4, 20, 9, 31)
    empty = store.load_bars(spark, folder, "SPY", datetime(2020, 1, 1), datetime(2020, 1, 2), 1, 1)
    never = store.load_bars(spark, folder, "NOPE", START, END, 1, 1)
    assert empty.count() == never.count() == 0
    assert [(f.name, f.dataType) for f in never.schema] == [(f.name, f.dataType) for f in got.schema]
    assert got.unionByName(never).unionByName(empty).count() == 3
    aware = datetime(2026, 4, 20, 13, 31, tzinfo=timezone.utc)
    assert store.load_bars(spark, folder, ["SPY", "007"], aware, END, 1, 1).count() == 6
    found = [r[0] for r in store.discover_symbols(spark, folder, 1, 1).collect()]
    assert found == sorted(["SPY", "$TICK", "BRK.B", "007", "A=B/C"])


def test_filters_reach_the_scan(spark, folder):
    store.append_intraday(two_symbols(spark), folder)
    got = store.load_bars(spark, folder, "SPY", START, END, 1, 1).select("bar_time", "close")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(bar_time" in plan and "date" in plan.split("PartitionFilters")[1][:300]
    assert "el_volume" not in plan.split("ReadSchema")[1]


def test_open_files_are_skipped_and_reported(spark, folder):
    store.append_intraday(two_symbols(spark), folder)
    broken = Path(folder, "bartype=1/interval=1/symbol=SPY/date=2026-04-22")
    broken.mkdir(parents=True)
    (broken / "bars.parquet").write_bytes(b"PAR1 still open")
    assert store.load_bars(spark, folder, "SPY", START, datetime(2026, 4, 23), 1, 1).count() == 4
    skipped = store.unreadable_files(spark, folder, 1, 1)
    assert collect(skipped, "symbol", "date") == [("SPY", date(2026, 4, 22))]


def test_foreign_store_is_refused(spark, folder):
    rows = two_symbols(spark)
    store.write_imputed(rows.withColumn("imputed", F.lit(False)), "/elsewhere", folder)
    with pytest.raises(store.OtherSchema, match="imputed"):
        store.load_bars(spark, folder, "SPY", START, END, 1, 1)
    with pytest.raises(ValueError):
        store.write_imputed(rows, folder, folder + "/")
    old = f"{folder}/old/bartype=1/interval=1/symbol=SPY/date=2026-04-20"
    rows.select("bar_time", "close").write.parquet(old)
    with pytest.raises(store.OtherSchema, match="absent"):
        store.load_bars(spark, f"{folder}/old", "SPY", START, END, 1, 1)


def daily(spark, days, close, interval=1):
    start = datetime(2026, 4, 1, 20, tzinfo=timezone.utc)
    return bars(
        spark,
        [
            {"bar_type": 2, "bar_interval": interval, "bar_time": start + timedelta(days=d), "close": close}
            for d in days
        ],
    )


def test_daily_merge_keeps_the_later_row(spark, folder):
    root, staging = f"{folder}/store", f"{folder}/staging"
    assert store.merge_daily(daily(spark, [0, 1, 2], 1.0), root, staging) == []
    assert store.merge_daily(daily(spark, [2, 3], 2.0), root, staging) == []
    got = store.load_bars(spark, root, "SPY", datetime(2026, 1, 1), datetime(2026, 12, 31), 2, 1)
    assert collect(got, "close") == [(1.0,), (1.0,), (2.0,), (2.0,)]
    assert "date" not in got.columns


def test_daily_merge_reports_an_old_schema_and_goes_on(spark, folder):
    root, staging = f"{folder}/store", f"{folder}/staging"
    old = daily(spark, [0], 1.0).select("bar_time", F.col("el_volume").alias("volume"))
    old.write.parquet(f"{root}/bartype=2/interval=1/symbol=SPY")
    both = daily(spark, [0], 1.0).unionByName(daily(spark, [1], 2.0, interval=2))
    failed = store.merge_daily(both, root, staging)
    assert [f[:2] for f in failed] == [(1, "SPY")] and "el_volume" in failed[0][2]
    assert spark.read.parquet(f"{root}/bartype=2/interval=1").where("symbol = 'SPY'").count() == 1
    assert store.load_bars(spark, root, "SPY", datetime(2026, 1, 1), datetime(2026, 12, 31), 2, 2).count() == 1


def test_dedupe_keeps_the_first_landed_row(spark, folder):
    root = f"{folder}/store"
    store.append_intraday(bars(spark, [{"bar_time": minute(n), "close": 1.0} for n in (0, 1)]), root)
    store.append_intraday(bars(spark, [{"bar_time": minute(n), "close": 2.0} for n in (1, 2)]), root)
    dry = store.dedupe(spark, root, 1, 1, f"{folder}/dry", dry_run=True)
    assert merge.dedupe_totals(dry).first()["rows_removed"] == 1
    assert store.scan(spark, root, 1, 1).count() == 4
    store.dedupe(spark, root, 1, 1, f"{folder}/staging")
    kept = store.scan(spark, root, 1, 1).orderBy("bar_time")
    assert collect(kept, "close") == [(1.0,), (1.0,), (2.0,)]
    store.compact(spark, root, 1, 1, f"{folder}/compact", date(2026, 4, 21))
    assert store.scan(spark, root, 1, 1).count() == 3
    assert len(list(Path(root).rglob("*.parquet"))) == 1


def two_daily(spark, days, close):
    """Daily bars of a good series and of one that a test spoils."""
    spoiled = daily(spark, days, close).withColumn("symbol", F.lit("BAD"))
    return daily(spark, days, close).unionByName(spoiled)


def spoil_by_damage(spark, path, rows):
    (Path(path) / "open.parquet").write_bytes(b"PAR1 still open")


def spoil_by_missing_column(spark, path, rows):
    rows.drop("el_ticks").write.mode("append").parquet(path)


def spoil_by_further_column(spark, path, rows):
    rows.withColumn("imputed", F.lit(True)).write.mode("append").parquet(path)


@pytest.mark.parametrize("spoil", [spoil_by_damage, spoil_by_missing_column, spoil_by_further_column])
def test_a_spoiled_daily_series_keeps_every_row(spark, folder, spoil):
    root, staging = f"{folder}/store", f"{folder}/staging"
    store.merge_daily(two_daily(spark, [0, 1, 2], 1.0), root, staging)
    path = f"{root}/bartype=2/interval=1/symbol=BAD"
    spoil(spark, path, daily(spark, [9], 7.0).select(*BAR_COLUMNS))
    before = {f: f.read_bytes() for f in Path(path).glob("*.parquet")}
    failed = store.merge_daily(two_daily(spark, [2, 3], 2.0), root, f"{staging}/2")
    assert [f[:2] for f in failed] == [(1, "BAD")]
    assert {f: f.read_bytes() for f in Path(path).glob("*.parquet")} == before
    good = spark.read.parquet(f"{root}/bartype=2/interval=1/symbol=SPY").orderBy("bar_time")
    assert collect(good, "close") == [(1.0,), (1.0,), (2.0,), (2.0,)]


@pytest.mark.parametrize("spoil", [spoil_by_damage, spoil_by_missing_column, spoil_by_further_column])
def test_rewrites_leave_spoiled_partitions_alone(spark, folder, spoil):
    root = f"{folder}/store"
    rows = bars(spark, [{"bar_time": minute(n), "symbol": s} for n in (0, 1) for s in ("SPY", "BAD")])
    for _ in range(2):
        store.append_intraday(rows, root)
    path = f"{root}/bartype=1/interval=1/symbol=BAD/date=2026-04-20"
    spoil(spark, path, rows.limit(1).select(*BAR_COLUMNS))
    before = {f: f.read_bytes() for f in Path(path).glob("*.parquet")}
    done = store.compact(spark, root, 1, 1, f"{folder}/c", date(2026, 4, 21)).collect()
    assert {r["symbol"]: r["reason"] is None for r in done} == {"SPY": True, "BAD": False}
    report = store.dedupe(spark, root, 1, 1, f"{folder}/d").collect()
    assert {r["symbol"]: r["reason"] is None for r in report} == {"SPY": True, "BAD": False}
    assert {f: f.read_bytes() for f in Path(path).glob("*.parquet")} == before
    assert spark.read.parquet(f"{root}/bartype=1/interval=1/symbol=SPY").count() == 2


def test_a_file_without_a_column_fails_the_read_of_that_column(spark, folder):
    store.append_intraday(bars(spark, [{"bar_time": minute(0)}]), folder)
    path = f"{folder}/bartype=1/interval=1/symbol=SPY/date=2026-04-20"
    spoil_by_missing_column(spark, path, bars(spark, [{"bar_time": minute(1)}]).select(*BAR_COLUMNS))
    found = store.scan(spark, folder, 1, 1)
    assert found.select("close").count() == 2
    with pytest.raises(Exception, match="el_ticks is absent"):
        found.select("el_ticks").collect()


def test_large_files_are_not_compacted(spark, folder, monkeypatch):
    monkeypatch.setattr(store, "TARGET_BYTES", 10)
    for n in (0, 1):
        store.append_intraday(bars(spark, [{"bar_time": minute(n)}]), f"{folder}/s")
    assert store.compact(spark, f"{folder}/s", 1, 1, f"{folder}/c", date(2026, 5, 1)).collect() == []


def test_a_batch_lands_once_ticks_included(spark, folder):
    root = f"{folder}/store"
    ticks = bars(spark, [{"bar_time": minute(0), "bar_type": 0, "ts": 1.0}] * 2)
    other = bars(spark, [{"bar_time": minute(n)} for n in (0, 1)])
    for batch, rows in ((0, ticks), (1, other), (1, other), (0, ticks)):
        store.append_batch(rows, root, f"{folder}/staging", batch)
    assert store.scan(spark, root, 0, 1).count() == 2 and store.scan(spark, root, 1, 1).count() == 2


def test_the_row_that_arrived_later_wins_an_equal_time(spark, folder):
    root, same = f"{folder}/store", {"bar_type": 2, "bar_time": minute(0), "ts": 5.0}
    rows = [{"arrival": 8, "close": 2.0, **same}, {"arrival": 7, "close": 1.0, **same}]
    store.merge_daily(bars(spark, rows), root, f"{folder}/staging")
    assert collect(store.scan(spark, root, 2, 1), "close") == [(2.0,)]


def test_skipped_files_come_with_the_answer(spark, folder):
    store.append_intraday(two_symbols(spark), folder)
    for symbol in ("SPY", "007"):
        place = Path(folder, f"bartype=1/interval=1/symbol={symbol}/date=2026-04-23")
        place.mkdir(parents=True)
        (place / "bars.parquet").write_bytes(b"PAR1 still open")
    got = store.load_with_skipped(spark, folder, "SPY", START, datetime(2026, 4, 23), 1, 1)
    assert got.bars.count() == 4 and collect(got.skipped, "symbol", "date") == [("SPY", date(2026, 4, 23))]
    # A range that never opens the file has nothing to report.
    got = store.load_with_skipped(spark, folder, "SPY", START, END, 1, 1)
    assert got.bars.count() == 3 and got.skipped.count() == 0
    assert store.load_with_skipped(spark, f"{folder}/none", "SPY", START, END, 1, 1).skipped.count() == 0


def test_dedupe_leaves_tick_series_alone(spark, folder):
    ticks = [{"bar_time": minute(0), "bar_type": 0, "ts": float(i)} for i in range(5)]
    store.append_intraday(bars(spark, ticks), folder)
    report = store.dedupe(spark, folder, 0, 1, f"{folder}-staging")
    totals = merge.dedupe_totals(report).first()
    assert (totals["rows_removed"], totals["tick_files_skipped"]) == (0, 1)
    in_order = store.load_bars(spark, folder, "SPY", datetime(2026, 1, 1), datetime(2026, 12, 31), 0, 1)
    assert collect(in_order, "ts") == [(float(i),) for i in range(5)]


def test_preview(spark):
    rows = two_symbols(spark)
    got = preview.preview(rows, ["bar_time", "el_volume"], "-el_volume", head=2, tail=1, zone="America/New_York")
    assert collect(got, "el_volume") == [(2440,), (2440,), (1000,)]
    assert got.first()["bar_time"] == datetime(2026, 4, 21, 9, 30)
    assert preview.preview(rows, limit=4).count() == 4
    with pytest.raises(ValueError, match="nope"):
        preview.preview(rows, ["nope"])
    assert BAR_COLUMNS[0] == "bar_time"


def test_skipped_files_are_looked_for_in_the_range_alone(spark, folder):
    """Damaged files of other symbols and days are neither listed nor opened."""
    import glob

    root = f"{folder}/store"
    rows = [{"symbol": s, "bar_time": minute(24 * 60 * d), "arrival": d} for s in ("A", "B") for d in range(9)]
    store.append_intraday(store.as_bars(points(spark, rows)), root)
    for place in glob.glob(f"{root}/bartype=1/interval=1/symbol=*/date=*"):
        if "symbol=B" in place or place.endswith((f"{minute(0):%Y-%m-%d}", f"{minute(5 * 1440):%Y-%m-%d}")):
            Path(place, "open.parquet").write_bytes(b"PAR1 still open")
    start, end = minute(4 * 1440).replace(tzinfo=None), minute(6 * 1440).replace(tzinfo=None)
    found = store.load_with_skipped(spark, root, "A", start, end, 1, 1)
    day = minute(5 * 1440).date()
    assert collect(found.skipped, "symbol", "date") == [("A", day)]
    assert found.bars.count() == 2
    read = [str(p) for p in found.skipped.inputFiles() if p.endswith(".parquet")]
    assert read and all("symbol=A" in p for p in read)
    plan = found.skipped._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert len(collect(store.unreadable_files(spark, root, 1, 1), "path")) == 9 + 2
    assert store.load_with_skipped(spark, root, "C", start, end, 1, 1).skipped.count() == 0
