"""Whole jobs over a store, as a user calls them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from barloom.operators import completeness as cp
from barloom.operators import impute as imp
from barloom.operators.sides import staged
from barloom.sources import store


@dataclass(frozen=True)
class Verification:
    """Answers of one completeness check."""

    report: DataFrame
    gaps: DataFrame
    summary: DataFrame
    thin: DataFrame
    totals: DataFrame


def _unreadable_days(spark: SparkSession, root: str, scope: cp.Scope) -> DataFrame | None:
    try:
        files = store.unreadable_files(spark, root, scope.bar_type, scope.bar_interval)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return files.select("symbol", "date")


def verify_store(
    spark: SparkSession, root: str, scope: cp.Scope, symbols: Sequence[str] | None = None
) -> Verification:
    """Check a store against its own learned bar times, all symbols at once.

    The bars are scanned twice: once to learn, once to compare. A symbol that was asked
    for and has no data counts as one with too few days.
    """
    bars = store.scan(spark, root, scope.bar_type, scope.bar_interval, symbols)
    learned = cp.learn(bars, scope)
    slots = staged(cp.reconcile(bars, learned.profile, scope), "slots")
    report = staged(
        cp.day_report(bars, scope, _unreadable_days(spark, root, scope), learned, slots), "report"
    )
    if symbols is None:
        asked = store.discover_symbols(spark, root, scope.bar_type, scope.bar_interval)
    else:
        asked = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    thin = cp.thin_symbols(bars, scope, asked, learned.reference)
    counts = cp.symbol_counts(report)
    return Verification(
        report=report,
        gaps=cp.gap_text(cp.gap_runs(slots), scope.zone),
        summary=cp.cross_summary(counts),
        thin=thin,
        totals=cp.totals(counts, thin),
    )


def impute_store(
    spark: SparkSession,
    root: str,
    output: str,
    scope: cp.Scope,
    method: str = "ffill",
    symbols: Sequence[str] | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Write a filled copy of a store under another root; returns the report per
    symbol. A dry run only reports."""
    if output.rstrip("/") == root.rstrip("/"):
        raise ValueError("the imputed copy must not be written into the collected store")
    bars = store.scan(spark, root, scope.bar_type, scope.bar_interval, symbols)
    learned = cp.learn(bars, scope)
    slots = staged(cp.reconcile(bars, learned.profile, scope), "slots")
    report = staged(imp.report(bars, scope, method, learned=learned, slots=slots), "imputation")
    if not dry_run:
        filled = imp.impute(bars, scope, method, learned=learned, slots=slots)
        store.write_imputed(filled, root, output)
    return report
