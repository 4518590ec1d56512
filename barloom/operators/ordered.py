"""Running values in arrival order, without one task per key.

A window over one symbol puts the whole symbol into one task, and one symbol may
hold a third of all rows. Here each key's rows are cut into segments of the order
column. Every segment gets one *seed* row that carries what came before it, so a
window over (key, segment) gives the same answer as a window over the key. Seeds
come from per-segment aggregates, which are combined before the shuffle; only
that summary, one row per segment, is ordered per key.

The order column must be a unique integer that grows densely (a landing number or
a log offset), so a segment holds at most `width` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SEGMENT_WIDTH = 1 << 18
SEGMENT, SEED = "_segment", "_seed"
SALTS = 64


def seeded(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    maxima: Sequence[str] = (),
    previous: Sequence[str] = (),
    history: DataFrame | None = None,
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """Add one seed row per (key, segment) in front of the segment's rows.

    A seed holds, for each column of `maxima`, the largest value of all earlier
    segments and, for each column of `previous`, the value of the last earlier
    row. `history` holds the same columns per key from before this data.
    """
    rows = df.withColumn(SEGMENT, F.floor(F.col(order) / width).cast("bigint"))
    summary = rows.groupBy(*keys, SEGMENT).agg(
        *[F.max(c).alias(c) for c in maxima],
        *[F.max_by(c, order).alias(c) for c in previous],
    )
    if history is not None:
        before = history.select(*keys, F.lit(None).cast("bigint").alias(SEGMENT), *maxima, *previous)
        summary = summary.unionByName(before)
    by_segment = Window.partitionBy(*keys).orderBy(F.col(SEGMENT).asc_nulls_first())
    earlier = by_segment.rowsBetween(Window.unboundedPreceding, -1)
    seeds = summary.select(
        *keys,
        SEGMENT,
        *[F.max(c).over(earlier).alias(c) for c in maxima],
        *[F.lag(c).over(by_segment).alias(c) for c in previous],
        F.lit(True).alias(SEED),
    ).where(F.col(SEGMENT).isNotNull())
    return rows.withColumn(SEED, F.lit(False)).unionByName(seeds, allowMissingColumns=True)


def in_segment(keys: Sequence[str], order: str) -> WindowSpec:
    """The window that sees a segment's rows, its seed first."""
    return Window.partitionBy(*keys, SEGMENT).orderBy(F.col(order).asc_nulls_first())


def max_before(column: str, keys: Sequence[str], order: str) -> Column:
    """The largest value before this row; for use on `seeded` rows."""
    w = in_segment(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    return F.max(column).over(w)


def value_before(column: str, keys: Sequence[str], order: str) -> Column:
    """The value of the row before this one; for use on `seeded` rows."""
    return F.lag(column).over(in_segment(keys, order))


def unseeded(df: DataFrame) -> DataFrame:
    return df.where(~F.col(SEED)).drop(SEED, SEGMENT)


def last_by(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row per key. One aggregate per column keeps the buffers fixed in
    size, so rows are combined by hash before the shuffle."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    return (
        df.groupBy(*keys)
        .agg(*[F.max_by(c, order).alias(c) for c in rest], F.max(order).alias(order))
        .select(*df.columns)
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first `n` rows per key in a given order.

    Spark limits each group inside every task before the shuffle, so a hot key
    sends at most `n` rows per task. Beyond the size up to which it does so, the
    key is first cut into salted parts, whose first `n` rows hold the answer.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
        parts = _ranked(df.withColumn("_salt", salt), [*keys, "_salt"], order, n)
        df = parts.drop("_salt")
    return _ranked(df, keys, order, n)


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
