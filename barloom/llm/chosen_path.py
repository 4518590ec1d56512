"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct word shingles. Several independent trees send every
set down the branches of a few of its minwise tokens; sets that agree on a token meet in a
node. Small nodes are compared exhaustively, large ones are met by pivots and branch again
by further minwise tokens (`linking`). Each likely pair is confirmed on the full sets.
Documents with equal sets are one class from the start and are never paired.

A pair of similarity s shares none of the `trees * 2` tokens of the first level with a
chance of (1 - s) ** (trees * 2): 4e-9 at 0.8 with six trees. The sketch that screens
pairs holds two bits of each of 128 minwise tokens; one that differs in up to `SCREEN` of
them passes, which a pair of similarity 0.8 misses with a chance of about 1e-5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import Scratch, WordHashes, key_filter, may_have, window_hashes
from barloom.llm.linking import Linker, with_component

MINS = 128  # minwise tokens per set; the sketch has two bits of each
PATHS = 48  # of them, those kept for choosing paths
SCREEN = 37
LONG = 20_000  # sets of more shingles are compared pair by pair, others a block at a time
EVEN_BITS = 0x5555555555555555
_RNG = np.random.default_rng(20250307)
_FACTORS = _RNG.integers(1, 2**63, MINS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FINGERPRINT = "n_shingles bigint, cid binary, s0 bigint, s1 bigint, s2 bigint, s3 bigint, mins array<bigint>"


def shingle_set(text: bytes, size: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, one without words none."""
    words = text.lower().split()  # both know only ASCII letters and white space
    if not words:
        return np.empty(0, np.uint64)
    hashes = cache.of(words)
    return np.unique(window_hashes(hashes, min(size, len(words))))


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The smallest product with each factor, over pieces that fit the processor's cache."""
    least = np.full(MINS, 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[i : i + 1024, None] * _FACTORS).min(0), out=least)
    return least


def fingerprints(size: int):
    """Arrow function: text bytes to the fields of `FINGERPRINT`."""

    @F.arrow_udf(FINGERPRINT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = WordHashes()
        shifts = np.arange(0, 64, 2, dtype=np.uint64)
        for batch in batches:
            n, cid, sketch, mins = [], [], [], []
            for text in batch.to_pylist():
                s = shingle_set(text or b"", size, cache)
                n.append(len(s))
                if not len(s):
                    cid.append(None), sketch.append((0, 0, 0, 0)), mins.append(None)
                    continue
                least = minwise(s)
                two = ((least >> np.uint64(20)) & np.uint64(3)).reshape(4, 32)
                cid.append(xxhash.xxh3_128_digest(s.tobytes()))
                sketch.append((two << shifts).sum(1, dtype=np.uint64).view(np.int64))
                mins.append(least[:PATHS].view(np.int64))
            sketch = np.array(sketch, np.int64).reshape(-1, 4)
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(cid, pa.binary()), *[pa.array(sketch[:, i].copy()) for i in range(4)],
                 pa.array(mins, pa.list_(pa.int64()))],
                names=["n_shingles", "cid", "s0", "s1", "s2", "s3", "mins"],
            )

    return run


def full_sets(size: int, wanted):
    """Arrow function: (hash, text bytes) to the whole set if the hash is wanted."""

    @F.arrow_udf("cid binary, shingles array<bigint>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        cache, words = WordHashes(), wanted.value
        for hashes, texts in batches:
            cid, sets = [], []
            for take, text in zip(may_have(words, hashes.to_numpy(zero_copy_only=False)), texts):
                s = shingle_set(text.as_py() or b"", size, cache) if take else ()
                cid.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sets.append(s.view(np.int64) if len(s) else None)
            yield pa.StructArray.from_arrays(
                [pa.array(cid, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                names=["cid", "shingles"],
            )

    return run


def confirmed(min_percent: int):
    """Arrow function: a block's sets, then its pairs, to pairs alike enough that tie it together.

    Rows come sorted by block, those with a set before those with a pair. A pair whose ends
    are tied by others of its block already is not compared. Only one block is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sets, tied = None, {}, {}

        def top(x: bytes) -> bytes:
            while x in tied:
                x = tied[x]
            return x

        for batch in batches:
            shingles, found = batch.column("shingles"), []
            rows = zip(batch.column("block").to_pylist(), batch.column("a").to_pylist(), batch.column("b").to_pylist())
            for i, (of, a, b) in enumerate(rows):
                if of != block:
                    block, sets, tied = of, {}, {}
                if b is None:
                    sets[a] = np.array(shingles[i].values)
                    continue
                x, y = top(a), top(b)
                if x == y:
                    continue
                n = len(sets[a]) + len(sets[b])
                shared = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * shared >= min_percent * (n - shared):
                    tied[x] = y
                    found.append((a, b))
            ends = list(zip(*found)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.binary()) for e in ends], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    min_percent: int = 80,
    trees: int = 6,
    leaf: int = 64,
) -> DataFrame:
    """(id, text_hash, n_shingles, component_id, kept) of every row of `docs`.

    `component_id` is the smallest id of the connected group of documents whose shingle
    sets have a Jaccard similarity of at least `min_percent` percent; `kept` says whether
    it is the row's own. `text_hash` is xxhash64 of the text.

    A null or empty text has no shingles and is linked with nothing. A very long one is a set
    like others; a task holds two such sets at once. A null id counts as
    larger than any other: its row is kept only if no row of its group has an id. Rows
    that repeat an id are judged one by one. Other columns are not looked at. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "chosen-path")
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("id_"), text.alias("text_"))
    printed = rows.select(
        "id_",
        F.xxhash64("text_").alias("text_hash"),
        fingerprints(shingle_words)(F.col("text_").cast("binary")).alias("f"),
    ).select("id_", "text_hash", "f.*")
    prints = scratch.keep(printed, "prints")
    classes = (
        prints.where(F.col("cid").isNotNull())
        .groupBy("cid")
        .agg(
            F.min_by(F.struct("id_", "n_shingles", "s0", "s1", "s2", "s3", "mins"), F.struct(F.col("id_").isNull(), "id_")).alias("c")
        )
        .select(F.col("cid").alias("id"), "c.*")
    )
    classes = scratch.keep(classes, "classes")
    roots = F.array(
        *[F.xxhash64(F.lit(c // 2), F.lit(c), F.col("mins")[c]) for c in range(2 * trees)]
    )
    sketch = ["n_shingles", "s0", "s1", "s2", "s3"]
    paths = classes.select(F.explode(roots).alias("path"), "id", *sketch)

    def near(a: str, b: str):
        """Sizes and sketches that a pair of the wanted similarity can have."""
        off = F.lit(0)
        for s in ("s0", "s1", "s2", "s3"):
            d = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
            d = d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(EVEN_BITS).cast("bigint"))
            off = off + F.bit_count(d)
        n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
        return (off <= SCREEN) & (100 * F.least(n, m) >= min_percent * F.greatest(n, m))

    sets: list[DataFrame] = []

    def prepare(found: DataFrame, large: DataFrame) -> None:
        """Full sets of the classes that can be asked for, from one of their documents each."""
        asked = found.select(F.explode(F.array("a", "b")).alias("id")).unionByName(large.select("id"))
        first = classes.join(asked, "id", "left_semi").select(F.xxhash64("id_").alias("key"))
        wanted = key_filter(first, "key")
        made = rows.select(full_sets(shingle_words, wanted)(F.xxhash64("id_"), F.col("text_").cast("binary")).alias("f"))
        whole = made.select("f.*").where(F.col("cid").isNotNull()).dropDuplicates(["cid"])
        sets.append(scratch.keep(whole, "sets"))

    def verify(pairs: DataFrame) -> DataFrame:
        """Each set goes once to every block that has a pair of it."""
        pairs = scratch.keep(pairs, "asked")
        members = pairs.select("block", F.explode(F.array("a", "b")).alias("a")).distinct()
        known = members.join(sets[0].withColumnRenamed("cid", "a"), "a")
        rows = known.select("block", "a", F.lit(None).cast("binary").alias("b"), "shingles").unionByName(
            pairs.select("block", "a", "b", F.lit(None).cast("array<bigint>").alias("shingles"))
        )
        dealt = rows.repartition("block").sortWithinPartitions("block", F.col("b").isNotNull())
        return dealt.mapInArrow(confirmed(min_percent), "a binary, b binary")

    def branch(open_rows: DataFrame, level: int) -> DataFrame:
        """Three branches for every path, each of six further minwise tokens at once.

        That is six levels of one token in one step: a pair of similarity 0.8 meets in
        0.79 of the three branches on average, one of 0.7 only in 0.35.
        """
        keys = [
            [F.expr(f"mins[cast(pmod(xxhash64(path, {level}, {b}, {t}), {PATHS}) AS int)]") for t in range(6)]
            for b in range(3)
        ]
        split = open_rows.join(classes.select("id", "mins"), "id")
        paths = F.array(*[F.xxhash64("path", F.lit(b), *k) for b, k in enumerate(keys)])
        return split.select(F.explode(paths).alias("path"), "id", *sketch)

    stars = Linker(near, verify, branch, scratch, leaf, heavy=lambda side: F.col(f"{side}.n_shingles") > LONG).run(paths, prepare)
    labels = with_component(classes.select("id", "id_"), stars).select("id", "comp", "id_")
    groups = labels.groupBy("comp").agg(F.min("id_").alias("component_id"))
    by_class = labels.select("id", "comp").join(groups, "comp").select(F.col("id").alias("cid"), "component_id")
    alone = F.col("cid").isNull()
    result = prints.select("id_", "text_hash", "n_shingles", "cid").join(by_class, "cid", "left")
    component = F.when(alone, F.col("id_")).otherwise(F.col("component_id"))
    return result.select(
        F.col("id_").alias(id_col),
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.col("id_").eqNullSafe(component).alias("kept"),
    )
