"""Quality rules whose limits come from quantile sketches per language and source.

Fixed rules refuse what no corpus wants. All others are limits of a document's rates:
symbols, repeated lines and repeated windows per thousand words or lines, and the mean
length of a word. A limit lies `reach` spreads beyond the quartiles of the document's own
language and source, a spread being the distance of the quartiles but at least `least`.

The quantiles come from sketches that are merged by adding: counts per bucket, a bucket
holding values whose five leading binary digits agree, so that a quantile is off by at
most a sixteenth of itself. Their sums do not depend on the order of merging, so a task
that is run again gives the same limits. To every language and source's own documents
`weight` documents are added that are spread like those of its language: the same sum at
every size, so limits pass over smoothly from the language's to the group's own as it grows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import Scratch, unused

SYMBOLS = "#*$%&|<>"  # fixed values of the rules
SPACES = " \t\n\v\f\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5
SCALE = 1_000_000  # parts of a document in which blended sketches count
COUNTED = T.StructType([T.StructField(c, T.LongType()) for c in (*COUNTS, "n_lines")])


@dataclass(frozen=True)
class Rule:
    """A rate's name, its limit's side and the smallest spread of its quartiles."""

    rate: str
    upper: bool
    least: int


RULES = (
    Rule("symbol_rate", True, 25),
    Rule("dup_line_rate", True, 50),
    Rule("repeat_rate", True, 20),
    Rule("word_length", True, 100),
    Rule("word_length", False, 50),
)
RATES = tuple(dict.fromkeys(r.rate for r in RULES))


def repeat_words(words: list[bytes]) -> int:
    """Words within windows of `WINDOW` words that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    first: dict[bytes, int] = {}
    ids = np.array([first.setdefault(w, len(first)) for w in words], np.int64)
    pair = _ranks(ids[:-1], ids[1:])
    four = _ranks(pair[:-2], pair[2:])
    _, at, count = np.unique(four[:n] * len(first) + ids[WINDOW - 1 :], return_inverse=True, return_counts=True)
    begins = np.flatnonzero(count[at] > 1)
    if not len(begins):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, begins, 1)
    np.add.at(edge, begins + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A number for each distinct pair, below the number of pairs."""
    return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]


def counts_of(text: str) -> tuple[int, int, int, int, int, int]:
    """The five counts of a text and the number of its lines with a word."""
    data = text.encode()
    words = data.split()  # bytes are split at exactly the six ASCII spaces
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
    )


def _counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        rows = np.array([counts_of(t or "") for t in batch.to_pylist()], np.int64).reshape(-1, 6)
        columns = [pa.array(rows[:, i].copy()) for i in range(6)]
        yield pa.StructArray.from_arrays(columns, names=[*COUNTS, "n_lines"])


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row with `m`, the counts and rates of its whole text."""
    counts = F.arrow_udf(_counts, COUNTED)
    # Not deterministic for the planner only: filters must not compute the counts again.
    rows = docs.withColumn("m", counts.asNondeterministic()(F.col(text_col)))
    m = {c: F.col(f"m.{c}") for c in (*COUNTS, "n_lines")}

    def per_thousand(part: str, whole: str, scale: int = 1000) -> Column:
        return F.expr(f"if(m.{whole} = 0, 0, {scale} * m.{part} div m.{whole})")

    rates = {
        "symbol_rate": per_thousand("n_symbols", "n_words"),
        "dup_line_rate": per_thousand("n_dup_lines", "n_lines"),
        "repeat_rate": per_thousand("n_repeat_words", "n_words"),
        "word_length": per_thousand("word_chars", "n_words", 100),
    }
    return rows.withColumn("m", F.struct(*[v.alias(k) for k, v in (m | rates).items()]))


def base_failed() -> Column:
    return F.expr("m.n_words < 10 or 100 * m.n_repeat_words > 20 * m.n_words")


def bucket(value: Column) -> Column:
    """The smallest value with the same five leading binary digits."""
    digits = F.length(F.bin(value)) - 5
    cut = F.greatest(digits, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def sketches(rows: DataFrame) -> DataFrame:
    """Mergeable sketches: (lang, source, rate, at, n) of documents that pass the fixed rules."""
    rates = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), F.col(f"m.{r}").alias("value")) for r in RATES]))
    return (
        rows.where(~base_failed())
        .select("lang", "source", rates.alias("r"))
        .groupBy("lang", "source", F.col("r.rate").alias("rate"), bucket(F.col("r.value")).alias("at"))
        .agg(F.count("*").alias("n"))
    )


def quartiles(merged: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rate, q1, q3) of sketches merged to `keys`; the buckets of a group are few."""
    group = [*keys, "rate"]
    summed = merged.groupBy(*group, "at").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*group).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ranked = summed.withColumns({"upto": F.sum("n").over(upto), "docs": F.sum("n").over(Window.partitionBy(*group))})
    return ranked.groupBy(*group).agg(
        F.min(F.expr("if(4 * upto >= docs, at, null)")).alias("q1"),
        F.min(F.expr("if(4 * upto >= 3 * docs, at, null)")).alias("q3"),
    )


def blended(merged: DataFrame, weight: int) -> DataFrame:
    """Sketches in parts of a document: a group's own, and `weight` documents of its language."""
    lang = merged.groupBy(F.col("lang").alias("of"), F.col("rate").alias("of_rate"), "at").agg(F.sum("n").alias("n"))
    lang = lang.withColumn("total", F.sum("n").over(Window.partitionBy("of", "of_rate")))
    groups = merged.select("lang", "source", "rate").distinct()
    same = F.col("lang").eqNullSafe(F.col("of")) & (F.col("rate") == F.col("of_rate"))
    share = F.expr(f"{weight * SCALE} * n div total").alias("n")
    own = merged.select("lang", "source", "rate", "at", (F.col("n") * SCALE).alias("n"))
    return own.unionByName(groups.join(lang, same).select("lang", "source", "rate", "at", share))


def limits(merged: DataFrame, reach: int, weight: int) -> DataFrame:
    """One row per language and source with every rule's limit."""
    chosen = quartiles(blended(merged, weight), ["lang", "source"])
    fences = []
    for i, rule in enumerate(RULES):
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(rule.least))
        fence = F.col("q3") + reach * spread if rule.upper else F.col("q1") - reach * spread
        fences.append(F.max(F.when(F.col("rate") == rule.rate, fence)).alias(f"limit_{i}"))
    return chosen.groupBy("lang", "source").agg(*fences)


def judged(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    reach: int = 4, weight: int = 25,
) -> DataFrame:
    """Every row of `docs` with `m`, its counts and rates, `base_failed` and `kept`.

    The first pass over the texts makes the sketches, the second one judges; the limits,
    one row per language and source, are written between them and joined to the documents
    (broadcast only if their file is below Spark's own threshold). Null languages and
    sources are groups of their own. A null or empty text has no words and fails. A very long
    text is counted whole, within one task. Equal rows are judged alike. Columns named `m`,
    `base_failed` or `kept` are replaced, all others stay whatever their names. An empty
    table stays empty.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    slim = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    merged = scratch.keep(sketches(measured(slim)), "sketches")
    bounds = scratch.keep(limits(merged, reach, weight), "limits")
    rows = measured(docs.drop("m", "base_failed", "kept"), text_col)
    b = unused("bounds", rows)
    bounds = bounds.select(F.struct(*bounds.columns).alias(b))
    same = F.col(lang_col).eqNullSafe(F.col(f"{b}.lang")) & F.col(source_col).eqNullSafe(F.col(f"{b}.source"))
    rows = rows.withColumn("base_failed", base_failed()).join(bounds, same, "left")
    fits = ~F.col("base_failed")
    for i, rule in enumerate(RULES):
        value, limit = F.col(f"m.{rule.rate}"), F.col(f"{b}.limit_{i}")
        fits = fits & F.coalesce(value <= limit if rule.upper else value >= limit, F.lit(True))
    return rows.withColumn("kept", fits).drop(b)
