"""Registered queries that write a real store, let its jobs run on it and read it back."""

from __future__ import annotations

from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import functions as F

from barloom import jobs
from barloom.operators import wire_report
from barloom.plans import adapters as ad
from barloom.plans import bar_queries as bq
from barloom.plans import sql, wire_queries
from barloom.schemas import DAILY
from barloom.session import shared_dir
from barloom.sources import frames as fr
from barloom.sources import store

QUERIES, ORACLE = {}, {}
YEAR = datetime(2023, 1, 1), datetime(2025, 12, 31)
DAMAGED = date(2024, 1, 10)


def query(oracle: str):
    def register(fn):
        QUERIES[fn.__name__] = fn
        ORACLE[fn.__name__] = oracle
        return fn

    return register


def folders(spark) -> tuple[str, str]:
    """A new store's root, and a folder for its staging."""
    base = f"{shared_dir(spark)}/store-{uuid4().hex}"
    return f"{base}/store", f"{base}/staging"


def damage(spark, path: str) -> None:
    """Write a file that begins like Parquet and breaks off."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.writeBytes("PAR1 still being written")
    out.close()


@query(bq.ORACLE["daily_scan"])
def store_daily_scan(spark, sf_dir):
    root, staging = folders(spark)
    store.merge_daily(ad.daily_bars(spark, sf_dir), root, staging)
    return store.in_range(store.scan(spark, root, DAILY, 1), bq.START, bq.END)


@query(bq.ORACLE["symbol_discovery"])
def store_discovery(spark, sf_dir):
    root, _ = folders(spark)
    store.append_intraday(ad.bars(spark, sf_dir), root)
    return store.discover_symbols(spark, root, 1, 60)


@query(bq.ORACLE["daily_merge_last"])
def store_daily_merge(spark, sf_dir):
    """Daily bars of some events, then those of the others, merged into one store."""
    root, staging = folders(spark)
    store.merge_daily(ad.daily_bars(spark, sf_dir, F.col("value") < 20), root, staging)
    store.merge_daily(ad.daily_bars(spark, sf_dir, F.col("value") >= 20), root, f"{staging}/2")
    return store.scan(spark, root, DAILY, 1)


@query(sql.with_(sql.BARS, f"SELECT {bq.INTRADAY_LIST} FROM bars"))
def store_dedupe(spark, sf_dir):
    """A store in which half of the bars landed twice, cleaned."""
    root, staging = folders(spark)
    bars = ad.bars(spark, sf_dir)
    store.append_intraday(bars, root)
    store.append_intraday(bars.where("el_ticks % 2 = 0"), root)
    store.dedupe(spark, root, 1, 60, staging)
    return store.scan(spark, root, 1, 60)


@query(sql.with_(sql.BARS, f"SELECT {bq.INTRADAY_LIST} FROM bars"))
def store_batch_twice(spark, sf_dir):
    """Two batches of the live sink, each handed over twice."""
    root, staging = folders(spark)
    bars = ad.bars(spark, sf_dir)
    for i, part in enumerate((bars.where("el_ticks % 2 = 0"), bars.where("el_ticks % 2 <> 0"))):
        store.append_batch(part, root, staging, i)
        store.append_batch(part, root, staging, i)
    return store.scan(spark, root, 1, 60)


@query(
    sql.with_(
        sql.BARS,
        f"""SELECT symbol, {sql.day_text("date")} AS date, count(*) AS bars,
                   CAST(CASE WHEN date < DATE '2024-01-20' THEN 1 ELSE count(DISTINCT el_ticks % 3) END
                     AS BIGINT) AS files FROM bars GROUP BY symbol, date""",
    )
)
def store_compact(spark, sf_dir):
    """Bars that landed in three turns, old days rewritten into one file each."""
    root, staging = folders(spark)
    bars = ad.bars(spark, sf_dir)
    for i in range(3):
        store.append_intraday(bars.where(F.col("el_ticks") % 3 == i), root)
    store.compact(spark, root, 1, 60, staging, date(2024, 1, 20))
    files = store.listed_files(spark, store.chart_path(root, 1, 60)).groupBy("symbol", "date")
    held = store.scan(spark, root, 1, 60).groupBy("symbol", "date").agg(F.count("*").alias("bars"))
    return held.join(files.agg(F.count("*").alias("files")), ["symbol", "date"])


@query(
    sql.with_(
        sql.BARS,
        """SELECT (SELECT count(*) FROM bars WHERE symbol IN ('view', 'click')) AS bars,
                  CAST(1 AS BIGINT) AS skipped""",
    )
)
def store_skipped_files(spark, sf_dir):
    """Two symbols of a store with damaged files of two symbols."""
    root, _ = folders(spark)
    store.append_intraday(ad.bars(spark, sf_dir), root)
    for symbol in ("view", "error"):
        damage(spark, f"{store.chart_path(root, 1, 60, symbol)}/date={DAMAGED}/open.parquet")
    found = store.load_with_skipped(spark, root, ["view", "click"], *YEAR, 1, 60)
    n = found.skipped.agg(F.count("*").alias("skipped"))
    return found.bars.agg(F.count("*").alias("bars")).join(n)


@query(
    sql.with_(
        f"{sql.EVENTS},{sql.daily('old', 'value < 20')},{sql.daily('new', 'value >= 20')}",
        """SELECT symbol, CASE WHEN symbol IN ('click', 'view') THEN count(*) FILTER (was) ELSE count(DISTINCT bar_time) END AS bars,
                  symbol IN ('click', 'view') AS refused
           FROM (SELECT symbol, bar_time, true AS was FROM old UNION ALL SELECT symbol, bar_time, false FROM new)
           GROUP BY symbol""",
    )
)
def store_foreign_schema(spark, sf_dir):
    """A daily merge into a store in which one series lacks a column and one is damaged.

    Both keep every stored row; the others are merged.
    """
    root, staging = folders(spark)
    old = ad.daily_bars(spark, sf_dir, F.col("value") < 20)
    store.merge_daily(old.where("symbol <> 'click'"), root, staging)
    click = store.chart_path(root, DAILY, 1, "click")
    old.where("symbol = 'click'").drop("el_ticks", "bartype", "interval", "symbol").write.parquet(click)
    damage(spark, f"{store.chart_path(root, DAILY, 1, 'view')}/open.parquet")
    failed = store.merge_daily(ad.daily_bars(spark, sf_dir, F.col("value") >= 20), root, f"{staging}/2")
    refused = [symbol for _, symbol, _ in failed]
    rows = (
        spark.read.schema("bar_time timestamp, symbol string")
        .option("basePath", root)
        .option("ignoreCorruptFiles", True)
        .parquet(f"{root}/bartype={DAILY}")
    )
    return rows.groupBy("symbol").agg(F.count("*").alias("bars")).withColumn("refused", F.col("symbol").isin(refused))


@query(
    f"SELECT overall_bad + 1 AS overall_bad, overall_missing FROM ({bq.ORACLE['completeness_totals']})"
)
def store_verify(spark, sf_dir):
    """Every symbol of a store and one without data, which counts as bad."""
    root, _ = folders(spark)
    store.append_intraday(ad.bars(spark, sf_dir), root)
    names = [r[0] for r in store.discover_symbols(spark, root, 1, 60).collect()]
    return jobs.verify_store(spark, root, ad.HOURLY, [*names, "nobody"]).totals


@query(bq.ORACLE["impute_ffill"])
def store_impute(spark, sf_dir):
    """The filled copy that the job writes, read back."""
    root, _ = folders(spark)
    store.append_intraday(ad.bars(spark, sf_dir), root)
    jobs.impute_store(spark, root, f"{root}-filled", ad.HOURLY, "ffill")
    copy = spark.read.parquet(f"{root}-filled")
    return copy.select(*[F.col(c).cast("bigint") if c in ("bartype", "interval") else c for c in copy.columns])


@query(wire_queries.ORACLE["topic_counts"])
def recording_replay(spark, sf_dir):
    """Frames recorded as JSON lines and read back without their numbers."""
    root, _ = folders(spark)
    fr.write_frames(ad.frames(spark, sf_dir).drop("arrival"), root)
    return wire_report.most_common(wire_report.topic_counts(fr.read_recording(spark, root)))
