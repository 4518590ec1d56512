"""Sums and factors of all tasks, brought together a bounded number at a time."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import Scratch

FAN = 32


def folded(parts: DataFrame, fold: Callable[[pa.Table], pa.Table], scratch: Scratch, name: str, keys: tuple[str, ...] = (), fan: int = FAN) -> DataFrame:
    """One row per `keys` from rows with a `part` number: `fold` joins up to `fan` of them.

    `fold` gets rows with equal keys and gives one row of the same columns. Each level is
    written, so a lost executor costs one level at most; no table gives no row.
    """
    kept = scratch.keep(parts, name)
    last = kept.agg(F.max("part")).first()[0]
    while last:
        dealt = kept.withColumn("part", F.floor(F.col("part") / fan).cast("int"))
        kept = scratch.keep(dealt.groupBy(*keys, "part").applyInArrow(fold, kept.schema), name)
        last //= fan
    return kept
