"""Whole-number arithmetic that stays in BIGINT at its ends instead of failing.

A frame may carry any BIGINT; one such number must not end a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGEST, SMALLEST = 2**63 - 1, -(2**63)
_WIDE = "decimal(38,0)"


def _end(up: Column) -> Column:
    return F.when(up, F.lit(LARGEST)).otherwise(F.lit(SMALLEST))


def plus(a: Column, b: Column) -> Column:
    known = a.isNotNull() & b.isNotNull()
    return F.coalesce(F.try_add(a, b), F.when(known, _end(b > 0)))


def minus(a: Column, b: Column) -> Column:
    known = a.isNotNull() & b.isNotNull()
    return F.coalesce(F.try_subtract(a, b), F.when(known, _end(b < 0)))


def times(a: Column, b: Column) -> Column:
    known = a.isNotNull() & b.isNotNull()
    return F.coalesce(F.try_multiply(a, b), F.when(known, _end((a > 0) == (b > 0))))


def total(value: Column) -> Column:
    """The sum of a group, with digits enough for 10**18 rows of any size."""
    wide = F.sum(value.cast(_WIDE))
    inside = F.greatest(F.least(wide, F.lit(LARGEST).cast(_WIDE)), F.lit(SMALLEST).cast(_WIDE))
    return F.when(wide.isNotNull(), inside.cast("bigint"))
