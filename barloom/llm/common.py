"""Helpers shared by the operators: shared-folder tables, numbering, set filters, words."""

from __future__ import annotations

from uuid import uuid4

import numpy as np
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.session import shared_dir

PART_BITS = 33  # monotonically_increasing_id() keeps the row's number in these bits
MAX_SHIPPED_BYTES = 64 << 20  # no vocabulary, rule set or model above this is broadcast


class Scratch:
    """Tables that one call writes to the shared folder, to cut lineage.

    Every table gets a path of its own; `drop` removes one that no later step reads.
    Those a returned DataFrame reads stay until the folder's owner removes them.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/llm/{name}-{uuid4().hex}"
        self._made = 0

    def path(self, name: str) -> str:
        self._made += 1
        return f"{self.root}/{self._made:04d}-{name}"

    def keep(self, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
        """Write a table and read it back."""
        path = self.path(name)
        df.write.option("compression", compression).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            remove(self.spark, df.scratch_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path with the file system that Spark uses for it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(conf).delete(target, True)


def unused(name: str, *frames: DataFrame) -> str:
    """`name`, or `name` with as many underscores behind it as make it no column of `frames`."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shipped(spark: SparkSession, content: bytes, what: str) -> Broadcast:
    """Broadcast bytes whose size was checked."""
    if len(content) > MAX_SHIPPED_BYTES:
        raise ValueError(f"{what} has {len(content)} bytes; at most {MAX_SHIPPED_BYTES} are sent to executors")
    return spark.sparkContext.broadcast(content)


def numbered(df: DataFrame, order: list[Column], scratch: Scratch, out: str) -> DataFrame:
    """Every row with its 0-based position in the total order `order`, as BIGINT.

    A range shuffle sorts the rows; a position is the row's number in its partition
    plus the sizes of the partitions before. No window ever holds the rows: the only
    one runs over one line per partition. Rows must differ in `order` or be alike.
    """
    at, part, start = f"{out}_at", f"{out}_part", f"{out}_start"
    rows = (
        df.repartitionByRange(shuffle_parts(df.sparkSession), *order)
        .sortWithinPartitions(*order)
        .withColumn(at, F.monotonically_increasing_id())
    )
    kept = scratch.keep(rows, out)
    sizes = kept.groupBy(F.shiftright(at, PART_BITS).alias(part)).agg(F.count("*").alias("n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    number = F.col(at).bitwiseAND((1 << PART_BITS) - 1)
    return (
        kept.withColumn(part, F.shiftright(at, PART_BITS))
        .join(F.broadcast(starts), part)  # one line per partition
        .withColumn(out, (F.col(start) + number).cast("bigint"))
        .drop(at, part, start)
    )


def key_filter(keys: DataFrame, column: str, bits: int = 19) -> Broadcast:
    """A broadcast set of 64-bit hashes, for `may_have`.

    It may say yes to a few others but never no to its own. Its size is fixed by `bits`
    whatever the number of keys, 2**bits words of 8 bytes (4 MB at 19); with very many
    keys it only lets more rows through to the exact join behind it.
    """
    key = F.col(column)
    mask = F.lit(0).cast("bigint")
    for i in range(3):
        place = F.shiftrightunsigned(key, bits + 6 * i).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    rows = (
        keys.where(key.isNotNull())
        .select(key.bitwiseAND((1 << bits) - 1).alias("word"), mask.alias("mask"))
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()  # at most 2**bits lines
    )
    words = np.zeros(1 << bits, np.uint64)
    words[rows["word"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(words)


def may_have(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the hashes the set of `key_filter` may have."""
    bits, keys = len(words).bit_length() - 1, keys.view(np.uint64)
    mask = np.zeros(len(keys), np.uint64)
    for i in range(3):
        mask |= np.uint64(1) << ((keys >> np.uint64(bits + 6 * i)) & np.uint64(63))
    return (words[(keys & np.uint64(len(words) - 1)).astype(np.int64)] & mask) == mask


class WordHashes(dict):
    """64-bit hash of each word; remembers a bounded number of words."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.array(list(map(self.__getitem__, words)), np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every other."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    return x * np.uint64(0xD6E8FEB86659FD93)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """One hash per window of `size` neighbouring word hashes; empty if there are fewer."""
    n = len(h) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for j in range(1, size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : n + j]
    return mixed(out + np.uint64(size))
