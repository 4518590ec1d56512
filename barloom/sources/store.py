"""The bar store: Parquet under `bartype=/interval=/symbol=[/date=]`.

Daily charts (`bartype=2`) have no date level, so a read never starts above
`bartype=`: one read sees one depth. Bars in the store were collected; nothing
derived may enter it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import timeconv as tc
from barloom.operators import merge
from barloom.schemas import BAR, BAR_COLUMNS, DAILY, DAILY_KEYS, INTRADAY_KEYS, key_schema

# Columns in which no bar has a NULL.
REQUIRED = [f.name for f in BAR.fields if not f.nullable]
# How a bar's arrival number travels beside the published columns, until it is written.
LANDED = "_landed"

# Characters the partition writer escapes in directory names.
ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}


class OtherSchema(ValueError):
    """Parquet with other columns than this module writes."""


@dataclass(frozen=True)
class Answer:
    """Bars of a range, and the files that could not be read for it."""

    bars: DataFrame
    skipped: DataFrame


def _escape(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def _unescape(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def chart_path(root: str, bar_type: int, bar_interval: int, symbol: str | None = None) -> str:
    path = f"{root.rstrip('/')}/bartype={bar_type}/interval={bar_interval}"
    return path if symbol is None else f"{path}/symbol={_escape(symbol)}"


def answer_schema(bar_type: int) -> T.StructType:
    """Columns of every answer for a chart kind, empty or not."""
    return T.StructType([*BAR.fields, *key_schema(bar_type).fields])


def as_bars(points: DataFrame) -> DataFrame:
    """Closed points in the store's columns, with the path keys and the arrival number."""
    return points.select(
        "bar_time",
        tc.wall_clock(F.col("bar_time")).alias("bar_time_et"),
        *BAR_COLUMNS[2:],
        F.col("bar_type").cast("bigint").alias("bartype"),
        F.col("bar_interval").cast("bigint").alias("interval"),
        "symbol",
        F.when(F.col("bar_type") != DAILY, tc.partition_date(F.col("bar_time"))).alias("date"),
        *[F.col("arrival").alias(LANDED)] * ("arrival" in points.columns),
    )


# --- reading -----------------------------------------------------------------


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, by one listing of it; none if it does not exist."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []


def _symbol_folders(spark: SparkSession, root: str, bar_type: int, bar_interval: int) -> list[str]:
    names = _children(spark, chart_path(root, bar_type, bar_interval))
    return sorted(n for n in names if n.startswith("symbol="))


def _merged_fields(spark: SparkSession, root: str, paths: Sequence[str]) -> dict[str, T.DataType]:
    """Columns of any readable file below `paths`; the footers are read by the executors."""
    options = {"basePath": root, "ignoreCorruptFiles": True, "mergeSchema": True}
    try:
        found = spark.read.options(**options).parquet(*paths)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return {}
        raise
    except PySparkException as exc:
        if "MERGE_SCHEMA" in str(exc):
            raise OtherSchema(f"files below {paths[0]} disagree on a column's type") from exc
        raise
    return {f.name: f.dataType for f in found.schema}


def _complaint(extra: Sequence[str], missing: Sequence[str]) -> str:
    """What is wrong with the columns of files, in words."""
    parts = []
    if extra:
        parts.append(f"columns that bars do not have: {', '.join(extra)}")
    if missing:
        parts.append(f"bar columns that are absent: {', '.join(missing)}")
    if "imputed" in extra:
        parts.append("an imputed copy is no store of collected bars")
    return "; ".join(parts)


def scan(
    spark: SparkSession,
    root: str,
    bar_type: int,
    bar_interval: int,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """All bars of a chart kind, unreadable files skipped (see `unreadable_files`).

    Any file with a further column, or a column that no file has, is refused at once. A
    file that lacks a column others have fails the read when that column's value is used.
    Filters on time and keys and the choice of columns reach the Parquet scan;
    `bar_time_et` is derived instead of read.
    """
    schema = answer_schema(bar_type)
    folders = _symbol_folders(spark, root, bar_type, bar_interval)
    if symbols is not None:
        wanted = {f"symbol={_escape(s)}" for s in symbols}
        folders = [f for f in folders if f in wanted]
    base = chart_path(root, bar_type, bar_interval)
    paths = [f"{base}/{f}" for f in folders] if symbols is not None else [base] * bool(folders)
    found = _merged_fields(spark, root, paths) if paths else {}
    if not found:
        return spark.createDataFrame([], schema)
    names = schema.fieldNames()
    extra, missing = [c for c in found if c not in names], [c for c in names if c not in found]
    if extra or missing:
        raise OtherSchema(f"{paths[0]}: {_complaint(extra, missing)}")
    stored = T.StructType([f for f in schema.fields if f.name != "bar_time_et"])
    bars = (
        spark.read.schema(stored)
        .option("basePath", root)
        .option("ignoreCorruptFiles", True)
        .parquet(*paths)
    )

    def sound(name: str) -> Column:
        text = F.concat(F.lit(f"{name} is absent in "), F.col("_metadata.file_path"))
        return F.when(F.col(name).isNull(), F.raise_error(text)).otherwise(F.col(name)).alias(name)

    columns = {c: F.col(c) for c in names}
    columns |= {c: sound(c) for c in REQUIRED if c not in ("bar_time", "bar_time_et")}
    columns["bar_time_et"] = tc.wall_clock(F.col("bar_time")).alias("bar_time_et")
    return bars.select(*[columns[c] for c in names])


def days_of(start: datetime, end: datetime) -> tuple[date, date]:
    """The partition dates that a range reads: a day more than its own on both sides."""
    return tc.eastern_day(start) - timedelta(1), tc.eastern_day(end) + timedelta(1)


def in_range(bars: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Bars between two inclusive bounds, oldest first; naive bounds are Eastern.

    The `date` filter, a day wider on both sides, is what prunes partitions.
    """
    kept = bars.where(F.col("bar_time").between(tc.bound(start), tc.bound(end)))
    if "date" in bars.columns:
        kept = kept.where(F.col("date").between(*days_of(start, end)))
    return kept.orderBy("bar_time", "ts")


def load_bars(
    spark: SparkSession,
    root: str,
    symbol: str | Sequence[str],
    start: datetime,
    end: datetime,
    bar_type: int,
    bar_interval: int,
) -> DataFrame:
    """One chart's bars in a time range, or several symbols' stacked."""
    symbols = [symbol] if isinstance(symbol, str) else list(symbol)
    return in_range(scan(spark, root, bar_type, bar_interval, symbols), start, end)


def load_with_skipped(
    spark: SparkSession,
    root: str,
    symbol: str | Sequence[str],
    start: datetime,
    end: datetime,
    bar_type: int,
    bar_interval: int,
) -> Answer:
    """As `load_bars`, with the files that it opens and that give no row.

    Only folders of these symbols are listed, and only files of the range's days are read.
    """
    symbols = [symbol] if isinstance(symbol, str) else list(symbol)
    bars = load_bars(spark, root, symbols, start, end, bar_type, bar_interval)
    days = None if bar_type == DAILY else days_of(start, end)
    return Answer(bars, unreadable_files(spark, root, bar_type, bar_interval, symbols, days))


def listed_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet files below a path, or several, with their size and path keys; listing only, no content."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length")
    )

    def key(name: str) -> Column:
        return _unescape(F.regexp_extract("path", f"/{name}=([^/]+)/", 1))

    return files.select(
        "path",
        "length",
        key("interval").try_cast("bigint").alias("interval"),
        key("symbol").alias("symbol"),
        F.try_to_date(key("date")).alias("date"),
    )


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def _file_states(spark: SparkSession, root: str, bar_type: int, path: str) -> DataFrame:
    """Listed files below `path` with `problem`: NULL, or why their rows must not be rewritten.

    A file without a row is unreadable: it has no footer yet, or is damaged. One with a
    NULL where a bar has none lacks the column, one with a value in a further column is of
    another kind.
    """
    found = _merged_fields(spark, root, [path])
    keys = key_schema(bar_type).fields
    known = {f.name for f in answer_schema(bar_type).fields}
    extra = [T.StructField(c, kind) for c, kind in found.items() if c not in known]
    files = listed_files(spark, path)
    if not found:
        return files.withColumn("problem", F.lit("unreadable"))
    rows = (
        spark.read.schema(T.StructType([*BAR.fields, *extra, *keys]))
        .option("basePath", root)
        .option("ignoreCorruptFiles", True)
        .parquet(path)
    )
    absent = [F.when(F.max(F.col(c).isNull()), F.lit(c)) for c in REQUIRED]
    further = [F.when(F.count(F.col(f"`{f.name}`")) > 0, F.lit(f.name)) for f in extra]
    # The metadata column escapes a path once more than the listing.
    seen = rows.groupBy(_plain(_unescape(F.col("_metadata.file_path"))).alias("_key")).agg(
        F.array_compact(F.array(*absent)).alias("absent"),
        (F.array_compact(F.array(*further)) if further else F.array().cast("array<string>")).alias("further"),
    )
    words = F.concat_ws(
        ", ",
        F.when(F.size("further") > 0, F.concat(F.lit("has "), F.array_join("further", ", "))),
        F.when(F.size("absent") > 0, F.concat(F.lit("lacks "), F.array_join("absent", ", "))),
    )
    problem = F.when(F.col("absent").isNull(), F.lit("unreadable")).otherwise(F.nullif(words, F.lit("")))
    joined = files.withColumn("_key", _plain(F.col("path"))).join(seen, "_key", "left")
    return joined.withColumn("problem", problem).drop("_key", "absent", "further")


def unreadable_files(
    spark: SparkSession,
    root: str,
    bar_type: int,
    bar_interval: int,
    symbols: Sequence[str] | None = None,
    days: tuple[date, date] | None = None,
) -> DataFrame:
    """Listed files that give no row: no footer yet, or damaged.

    With `symbols` only their folders are listed; with `days`, a first and a last date, only
    files of those partitions are looked at.
    """
    folders = _symbol_folders(spark, root, bar_type, bar_interval)
    paths = [chart_path(root, bar_type, bar_interval)]
    if symbols is not None:
        wanted = {f"symbol={_escape(s)}" for s in symbols}
        paths = [f"{paths[0]}/{f}" for f in folders if f in wanted]
    if not folders or not paths:
        return spark.createDataFrame([], "path string, symbol string, date date")
    readable = (
        spark.read.schema(T.StructType([BAR["bar_time"], *key_schema(bar_type).fields]))
        .option("basePath", root)
        .option("ignoreCorruptFiles", True)
        .parquet(*paths)
    )
    files = listed_files(spark, paths)
    if days is not None:
        readable, files = (df.where(F.col("date").between(*days)) for df in (readable, files))
    seen = readable.select("bar_time", _plain(_unescape(F.col("_metadata.file_path"))).alias("_key"))
    keyed = files.withColumn("_key", _plain(F.col("path")))
    return keyed.join(seen.select("_key").distinct(), "_key", "left_anti").select("path", "symbol", "date")


def discover_symbols(spark: SparkSession, root: str, bar_type: int, bar_interval: int) -> DataFrame:
    """Symbols with a partition for a chart kind, sorted; one listing, no file is looked at."""
    folders = _symbol_folders(spark, root, bar_type, bar_interval)
    names = spark.createDataFrame([(f.removeprefix("symbol="),) for f in folders], "name string")
    return names.select(_unescape(F.col("name")).alias("symbol")).orderBy("symbol")


# --- writing -----------------------------------------------------------------

# Files from this size on are left alone by `compact`.
TARGET_BYTES = 128 << 20


def _write(bars: DataFrame, root: str, keys: Sequence[str], mode: str, **options: str) -> None:
    """One shuffle lays rows out by partition; `rebalance` lets the runtime split
    a hot partition and join small ones, so files come out even. Rows of one time
    lie in the order of their arrival, where that is known."""
    tie = LANDED if LANDED in bars.columns else "ts"
    (
        bars.hint("rebalance", *[F.col(k) for k in keys])
        .sortWithinPartitions(*keys, "bar_time", tie)
        .drop(LANDED)
        .write.mode(mode)
        .options(compression="zstd", **options)
        .partitionBy(*keys)
        .parquet(root)
    )


def _kept(bars: DataFrame, *names: str) -> DataFrame:
    return bars.select(*names, *[LANDED] * (LANDED in bars.columns))


def append_intraday(bars: DataFrame, root: str) -> None:
    """Append intraday bars (see `as_bars`) under their Eastern date."""
    keys = INTRADAY_KEYS.fieldNames()
    rows = _kept(bars.where(F.col("bartype") != DAILY), *BAR_COLUMNS, *keys)
    _write(rows, root, keys, "append")


def append_batch(bars: DataFrame, root: str, staging: str, batch_id: int) -> None:
    """Append intraday bars as batch `batch_id`, once however often it is run.

    The batch is laid out beside the store first. Its files are then moved in under names
    that carry the batch, in place of any that an earlier try of it has left. Do not
    `compact` a day while a batch for it may be run again.
    """
    spark, keys = bars.sparkSession, INTRADAY_KEYS.fieldNames()
    rows = _kept(bars.where(F.col("bartype") != DAILY), *BAR_COLUMNS, *keys)
    aside = f"{staging}/batch={batch_id}"
    _write(rows, aside, keys, "overwrite")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    top = str(fs.makeQualified(hadoop.Path(aside)))
    found, moves = fs.listFiles(hadoop.Path(aside), True), []
    while found.hasNext():  # one per partition the batch touches
        file = found.next().getPath()
        if file.getName().endswith(".parquet"):
            moves.append((file, str(file.getParent()).removeprefix(top)))
    for folder in {part for _, part in moves}:
        fs.mkdirs(hadoop.Path(root + folder))
        for left in fs.globStatus(hadoop.Path(hadoop.Path(root + folder), f"batch-{batch_id}-*")) or []:
            fs.delete(left.getPath(), False)
    for i, (file, part) in enumerate(moves):
        if not fs.rename(file, hadoop.Path(hadoop.Path(root + part), f"batch-{batch_id}-{i}.zstd.parquet")):
            raise OSError(f"{file} could not be moved into the store")
    fs.delete(hadoop.Path(aside), True)


def _replace(rows: DataFrame, root: str, keys: Sequence[str], staging: str) -> None:
    """Swap whole partitions for rows that may come from those very partitions."""
    rows.write.mode("overwrite").parquet(staging)
    staged = rows.sparkSession.read.schema(rows.schema).parquet(staging)
    _write(staged, root, keys, "overwrite", partitionOverwriteMode="dynamic")


def _refused(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partitions with a file that must not be rewritten, with one of the reasons.

    A wrong column is a better reason than a file without a row.
    """
    worst = F.min(F.struct("problem", "path"))
    bad = states.where("problem IS NOT NULL").groupBy(*keys).agg(worst.alias("w"))
    return bad.select(*keys, F.concat("w.path", F.lit(": "), "w.problem").alias("reason"))


def merge_daily(bars: DataFrame, root: str, staging: str) -> list[tuple[int, str, str]]:
    """Merge daily bars into the store; the row that arrived later wins a `bar_time`.

    Only touched series are rewritten, all in one job. A series with an unreadable file
    or one of another schema stays as it is, the others go on; returned are (interval,
    symbol, reason) of those that were refused.
    """
    spark = bars.sparkSession
    columns = [*BAR_COLUMNS, *DAILY_KEYS.fieldNames()]
    incoming = _kept(bars.where(F.col("bartype") == DAILY), *columns)
    if incoming.isEmpty():
        return []
    touched = incoming.select("interval", "symbol").distinct()
    path = f"{root.rstrip('/')}/bartype={DAILY}"
    failed: list[tuple[int, str, str]] = []
    stored = None
    if _children(spark, path):
        states = _file_states(spark, root, DAILY, path).join(touched, ["interval", "symbol"], "left_semi")
        refused = _refused(states, ["interval", "symbol"])
        refused.write.mode("overwrite").parquet(f"{staging}/refused")
        refused = spark.read.schema(refused.schema).parquet(f"{staging}/refused")
        failed = [tuple(r) for r in refused.select("interval", "symbol", "reason").collect()]
        incoming = incoming.join(refused, ["interval", "symbol"], "left_anti").select(*incoming.columns)
        # What cannot be read belongs to a refused series.
        stored = (
            spark.read.schema(T.StructType([*BAR.fields, *DAILY_KEYS.fields]))
            .option("basePath", root)
            .option("ignoreCorruptFiles", True)
            .parquet(path)
            .join(incoming.select("interval", "symbol").distinct(), ["interval", "symbol"], "left_semi")
            .select(*columns)
        )
    if stored is None:
        stored = spark.createDataFrame([], incoming.select(*columns).schema)
    order = "ts"
    if LANDED in incoming.columns:
        order, stored = LANDED, stored.withColumn(LANDED, F.lit(None).cast("bigint"))
    merged = merge.merge_last(stored, incoming, order, DAILY_KEYS.fieldNames())
    _replace(merged.select(*columns), root, DAILY_KEYS.fieldNames(), f"{staging}/rows")
    return failed


def _landed(spark: SparkSession, root: str, bar_type: int, bar_interval: int) -> DataFrame:
    """Stored bars with their landing order: file time, file, row."""
    schema = answer_schema(bar_type)
    return (
        spark.read.schema(T.StructType([f for f in schema.fields if f.name != "bar_time_et"]))
        .option("basePath", root)
        .option("ignoreCorruptFiles", True)
        .parquet(chart_path(root, bar_type, bar_interval))
        .withColumn("bar_time_et", tc.wall_clock(F.col("bar_time")))
        .select(
            *schema.fieldNames(),
            F.col("_metadata.file_modification_time").alias("_written"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.row_index").alias("_row"),
        )
    )


def _refused_partitions(
    spark: SparkSession, root: str, bar_type: int, bar_interval: int, staging: str
) -> DataFrame:
    """Written once: partitions of a chart kind that no rewrite may touch."""
    states = _file_states(spark, root, bar_type, chart_path(root, bar_type, bar_interval))
    keys = [k for k in key_schema(bar_type).fieldNames() if k not in ("bartype", "interval")]
    refused = _refused(states, keys)
    refused.write.mode("overwrite").parquet(f"{staging}/refused")
    return spark.read.schema(refused.schema).parquet(f"{staging}/refused")


def dedupe(
    spark: SparkSession,
    root: str,
    bar_type: int,
    bar_interval: int,
    staging: str,
    dry_run: bool = False,
) -> DataFrame:
    """Keep the first landed row of each `bar_time` per partition; rewrite only
    partitions that have repeats and no file that is unreadable or of another schema.
    Returns the report per partition; `reason` says why one was refused."""
    keys = key_schema(bar_type).fieldNames()
    landed = _landed(spark, root, bar_type, bar_interval)
    refused = _refused_partitions(spark, root, bar_type, bar_interval, staging)
    parts = [k for k in keys if k not in ("bartype", "interval")]
    # Cut from the files, which the rewrite below replaces.
    report = merge.dedupe_report(landed, keys).join(refused, parts, "left")
    report.write.mode("overwrite").parquet(f"{staging}/report")
    report = spark.read.schema(report.schema).parquet(f"{staging}/report")
    touched = report.where("rows_removed > 0 AND reason IS NULL").select(*keys)
    if not dry_run and not touched.isEmpty():
        order = [F.col("_written"), F.col("_file"), F.col("_row")]
        rows = merge.keep_first(landed.join(touched, list(keys), "left_semi"), order, list(keys))
        _replace(rows.select(*BAR_COLUMNS, *keys), root, keys, f"{staging}/rows")
    return report


def compact(
    spark: SparkSession,
    root: str,
    bar_type: int,
    bar_interval: int,
    staging: str,
    before: date,
) -> DataFrame:
    """Rewrite partitions of days before `before` that lie in several small files.

    Which ones is read off the listing: more than one file, and less than `TARGET_BYTES`
    on average. A partition with an unreadable file or one of another schema is left as it
    is. Returns (symbol, date, files, reason) of all candidates.
    """
    keys = INTRADAY_KEYS.fieldNames()
    files = listed_files(spark, chart_path(root, bar_type, bar_interval))
    small = (
        files.where(F.col("date") < F.lit(before))
        .groupBy("symbol", "date")
        .agg(F.count("*").alias("files"), F.avg("length").alias("size"))
        .where((F.col("files") > 1) & (F.col("size") < TARGET_BYTES))
        .drop("size")
    )
    refused = _refused_partitions(spark, root, bar_type, bar_interval, staging)
    report = small.join(refused, ["symbol", "date"], "left")
    report.write.mode("overwrite").parquet(f"{staging}/report")
    report = spark.read.schema(report.schema).parquet(f"{staging}/report")
    chosen = report.where("reason IS NULL").select("symbol", "date")
    if not chosen.isEmpty():
        rows = _landed(spark, root, bar_type, bar_interval).join(chosen, ["symbol", "date"], "left_semi")
        _replace(rows.select(*BAR_COLUMNS, *keys), root, keys, f"{staging}/rows")
    return report


def write_imputed(bars: DataFrame, source_root: str, output_root: str) -> None:
    """Write an imputed copy under another root than the collected bars."""
    if output_root.rstrip("/") == source_root.rstrip("/"):
        raise ValueError("the imputed copy must not be written into the collected store")
    keys = INTRADAY_KEYS.fieldNames()
    _write(bars.select(*BAR_COLUMNS, "imputed", *keys), output_root, keys, "overwrite",
           partitionOverwriteMode="dynamic")
