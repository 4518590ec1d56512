"""A look at a few rows of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def preview(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    sort_by: str | None = None,
    limit: int = 0,
    head: int = 0,
    tail: int = 0,
    zone: str | None = None,
) -> DataFrame:
    """Chosen columns, sorted, cut to the first and last rows, times in a zone.

    A leading `-` sorts downward. `limit` counts only without `head` and `tail`.
    Both ends are found by a limited sort, never by a full one.
    """
    unknown = [c for c in columns or [] if c not in df.columns]
    if unknown:
        raise ValueError(f"columns not in table: {unknown}")
    shown = df.select(*columns) if columns else df
    if sort_by is None:
        if tail:
            raise ValueError("the last rows of an unordered table are not defined; give sort_by")
        up = down = []
    else:
        key = F.col(sort_by.lstrip("-"))
        falling = sort_by.startswith("-")
        up = [key.desc() if falling else key.asc()]
        down = [key.asc() if falling else key.desc()]

    def first(n: int, order: list) -> DataFrame:
        ordered = shown.orderBy(*order) if order else shown
        return ordered.limit(n) if n else ordered

    if head and tail:
        out = first(head, up).unionByName(first(tail, down).orderBy(*up))
    elif tail:
        out = first(tail, down).orderBy(*up)
    else:
        out = first(head or limit, up)
    if zone is None:
        return out
    instants = [f.name for f in out.schema if isinstance(f.dataType, T.TimestampType)]
    return out.withColumns(
        {c: F.from_utc_timestamp(c, zone).cast("timestamp_ntz") for c in instants}
    )
