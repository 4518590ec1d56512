"""How registered queries hand out results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(df: DataFrame) -> DataFrame:
    """Instants as zone-free UTC, dates as text, integers as BIGINT."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, T.TimestampType):
            out[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DateType):
            out[f.name] = F.date_format(f.name, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            out[f.name] = F.col(f.name).cast("bigint")
    return df.withColumns(out) if out else df
