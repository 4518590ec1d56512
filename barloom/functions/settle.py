"""Keep an expensive column computed once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def settled(value: Column) -> Column:
    """Compute a column where it stands.

    A filter on it stays above it; pushed down, the condition would hold a second
    copy of the whole expression, such as the parse of a payload.
    """
    return F.when(F.spark_partition_id() >= 0, value)
