from pathlib import Path

import pytest
from feed import collect
from test_completeness import CLOSES, at, scope, sessions, stored, weekdays

from barloom import jobs
from barloom.sources import store


def test_verify_and_impute_a_store(spark, folder):
    root, output = f"{folder}/store", f"{folder}/imputed"
    days = weekdays(10)
    drop = [at(days[3], CLOSES[5]), at(days[3], CLOSES[6])]
    store.append_intraday(stored(spark, sessions(days, drop=drop)), root)
    store.append_intraday(stored(spark, sessions(days[:2]), "QQQ"), root)
    broken = Path(root, "bartype=1/interval=60/symbol=SPY/date=2026-04-20")
    broken.mkdir()
    (broken / "bars.parquet").write_bytes(b"PAR1")

    seen = jobs.verify_store(spark, root, scope(15))
    status = {r["date"].isoformat(): r["status"] for r in seen.report.collect()}
    assert status["2026-04-20"] == "UNREADABLE" and status["2026-04-21"] == "FILE_MISSING"
    assert status[days[3].isoformat()] == "INCOMPLETE"
    gaps = dict(collect(seen.gaps, "date", "gaps"))
    assert gaps[days[3]] == "11:30-12:30 (2)"
    assert collect(seen.thin, "symbol", "reference_days") == [("QQQ", 2)]
    assert tuple(seen.totals.first()) == (4, 17)
    assert collect(seen.summary, "symbol", "verdict") == [("SPY", "1d gap + 1d incomplete")]

    with pytest.raises(ValueError):
        jobs.impute_store(spark, root, root + "/", scope(15))
    dry = jobs.impute_store(spark, root, output, scope(15), dry_run=True).first()
    assert (dry["rows_imputed"], Path(output).exists()) == (2, False)
    jobs.impute_store(spark, root, output, scope(15), "interpolate", ["SPY"])
    copy = spark.read.parquet(output)
    assert copy.count() == 150 and copy.where("imputed").count() == 2
    with pytest.raises(store.OtherSchema, match="imputed"):
        store.scan(spark, output, 1, 60)


def test_symbols_without_data_count_as_bad(spark, folder):
    seen = jobs.verify_store(spark, f"{folder}/nothing", scope(15), ["SPY", "QQQ"])
    assert collect(seen.thin, "symbol", "reference_days") in (
        [("SPY", 0), ("QQQ", 0)], [("QQQ", 0), ("SPY", 0)],
    )
    assert tuple(seen.totals.first()) == (2, 0)


def test_an_empty_root_is_no_error(spark, folder):
    seen = jobs.verify_store(spark, f"{folder}/nothing", scope(15))
    assert seen.report.count() == 0 and tuple(seen.totals.first()) == (0, 0)
