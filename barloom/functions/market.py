"""Meaning of quotes, categories and quantities, for views on top of the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.schemas import DAILY, QUANTITIES, QUANTITY_LIMIT

# Instrument category codes of the charting terminal.
CATEGORY_NAMES = {
    0: "Future", 1: "Future Option", 2: "Stock", 3: "Stock Option", 4: "Index",
    5: "Currency Option", 6: "Mutual Fund", 7: "Money Market Fund", 8: "Index Option",
    9: "Cash", 10: "Bond", 11: "Spread", 12: "Forex", 13: "CPC Symbol", 14: "Composite",
    18: "Stock CFD", 19: "Forex CFD", 20: "Index CFD", 21: "Future CFD",
}
INDEX = 4


def quote(value: Column) -> Column:
    """A quote, or NULL for every spelling of "no quote"."""
    return F.when((value > 0) & ~F.isnan(value), value)


def category_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in CATEGORY_NAMES.items() for x in kv])
    return F.try_element_at(names, code.cast("int"))


def quantity_in_range(value: Column) -> Column:
    """What a publisher may send as an integer quantity."""
    return ~F.isnan(value) & (F.abs(value) <= QUANTITY_LIMIT)


def with_quantity_meaning(bars: DataFrame, bar_type: str = "bartype") -> DataFrame:
    """Name the quantities by what they count; belongs in a view, never in the store.

    The raw words swap meaning between intraday and daily charts: a daily chart
    has its total in `el_volume` and no up/down split, an intraday chart has its
    total in `el_ticks` and no open interest.
    """
    daily = F.col(bar_type) == DAILY
    return bars.withColumns(
        {
            "total_volume": F.when(daily, F.col("el_volume")).otherwise(F.col("el_ticks")),
            "up_volume": F.when(~daily, F.col("el_upticks")),
            "down_volume": F.when(~daily, F.col("el_downticks")),
            "open_interest": F.when(daily, F.col("el_open_interest")),
        }
    )


def mask_index_quotes(bars: DataFrame) -> DataFrame:
    """Drop quotes of index charts in a consumer's view."""
    index = F.col("category") == INDEX
    return bars.withColumns({c: F.when(~index, F.col(c)) for c in ("bid", "ask")})


def all_quantities_in_range() -> Column:
    ok = F.lit(True)
    for c in QUANTITIES:
        ok = ok & quantity_in_range(F.col(c).cast("double"))
    return ok
