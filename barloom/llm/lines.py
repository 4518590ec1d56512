"""Fuzzy line removal across documents.

Lines are normalised (lower case, no punctuation, one space between words). Equal
normalised lines are one line from the start, however short. Those long enough get a
64-bit SimHash of their words, or of their character runs where words are few; two that differ in at most `DISTANCE` = 3 of the 64 bits agree on two of five blocks, so they
meet under one of ten keys of 25 bits and more. With very many lines the bits are cut into
six or seven blocks, of which they agree on three or four: longer keys, so that no more
lines meet by chance. A key with many lines is split again by four parts of the bits
in which its lines differ, one of which they agree on too, and so on: no pair within the
distance is lost. Lines whose SimHashes are too much alike for that are all compared, tile by
tile. Pairs are verified by the edit similarity of the normalised lines; of every
connected group, the first line of the lowest document id stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import Scratch, key_filter, may_have, mixed, unused, window_hashes
from barloom.llm.linking import Linker

DISTANCE = 3
MOST_LINES = ((1 << 23, 5), (1 << 29, 6))  # lines up to which the bits are cut into so many blocks
LANE = 16
LANES = np.arange(0, 64, LANE, dtype=np.uint64)
BITS = np.arange(64, dtype=np.uint64)
NIBBLES = np.arange(0, 64, 4, dtype=np.uint64)
# The four bits of a number below 16, each in a lane of its own.
FOUR_BITS = ((np.arange(16, dtype=np.uint64)[:, None] >> np.arange(4, dtype=np.uint64) & np.uint64(1)) << LANES).sum(1, dtype=np.uint64)
# A word weighs this much at most, and so many are added before a lane could overflow.
HEAVIEST = 30
RUN = 4  # characters in a run, the feature of lines of few words
PART = 2000
# With so few bits that differ, four parts hold as many pairs as the whole; lines compared at once.
ALIKE_BITS = 8
TILE = 512
_SPACED = bytes(b if b > 127 or b == 10 or chr(b).isalnum() else 32 for b in range(256))
LINE = T.ArrayType(
    T.StructType(
        [
            T.StructField("no", T.IntegerType()),
            T.StructField("h1", T.LongType()),
            T.StructField("h2", T.LongType()),
            T.StructField("sim", T.LongType()),
            T.StructField("chars", T.IntegerType()),
        ]
    )
)


def normalised(text: str) -> list[tuple[int, list[bytes], bytes]]:
    """(number, words, line made of them) of every line with a word.

    Lower case; ASCII characters but letters and digits separate words.
    """
    out = []
    for no, line in enumerate(text.lower().encode().translate(_SPACED).split(b"\n")):
        words = line.split()
        if words:
            out.append((no, words, b" ".join(words)))
    return out


def features(words: list[bytes], line: bytes, min_words: int) -> list[bytes] | None:
    """What a line's SimHash is made of; None if it is too short to be compared.

    Its words, if there are `min_words` of them. Otherwise, as in scripts without spaces, its
    runs of `RUN` characters, if it has as many characters as `min_words` such runs.
    """
    if len(words) >= min_words:
        return words
    text = line.decode()
    if len(text) < RUN * min_words:
        return None
    return [text[i : i + RUN].encode() for i in range(len(text) - RUN + 1)]


class WordLanes(dict):
    """Each word's place in `rows`: the bits of its hash in lanes, times its weight.

    A word counts by its length, less two letters: short words are in most lines and would
    make the hashes of all of them alike. Starts anew when it has `LIMIT` words.
    """

    LIMIT = 250_000

    def __init__(self):
        super().__init__()
        self.rows = np.empty((1024, 16), np.uint64)
        self.weights = np.empty(1024, np.uint64)
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        self[word] = place = len(self)
        return place

    def places(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        out = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if self.new:
            h = np.array(list(map(xxhash.xxh3_64_intdigest, self.new)), np.uint64)
            lengths = np.array(list(map(len, self.new)), np.int64)
            weight = np.clip(lengths - 2, 1, HEAVIEST).astype(np.uint64)
            while len(self) > len(self.rows):
                self.rows = np.concatenate((self.rows, self.rows))
                self.weights = np.concatenate((self.weights, self.weights))
            new = slice(len(self) - len(h), len(self))
            self.rows[new] = FOUR_BITS[(h[:, None] >> NIBBLES) & np.uint64(15)] * weight[:, None]
            self.weights[new] = weight
            self.new = []
        return out


def simhashes(words: list[list[bytes]], cache: WordLanes) -> np.ndarray:
    """SimHash of every list of words: each bit as most of the words' hashes have it.

    Words are added up a few thousand at a time; four bits of a hash are counted in one
    integer, in `LANE` binary digits each, and a long line's parts are added at the end.
    """
    out = np.empty(len(words), np.uint64)
    i = 0
    while i < len(words):
        flat: list[bytes] = []
        starts, owners, first = [], [], i
        while i < len(words) and len(flat) < 20_000:
            for k in range(0, len(words[i]), PART):
                starts.append(len(flat)), owners.append(i - first)
                flat += words[i][k : k + PART]
            i += 1
        at = cache.places(flat)
        parts = np.add.reduceat(cache.rows[at], starts, axis=0)
        ones = ((parts[:, :, None] >> LANES) & np.uint64((1 << LANE) - 1)).reshape(len(starts), 64)
        each, total = np.zeros((i - first, 64), np.uint64), np.zeros(i - first, np.uint64)
        np.add.at(each, owners, ones)
        np.add.at(total, owners, np.add.reduceat(cache.weights[at], starts))
        out[first:i] = ((2 * each > total[:, None]).astype(np.uint64) << BITS).sum(1, dtype=np.uint64)
    return out


def _digests(lines: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each line."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), np.int64).reshape(-1, 2)


def line_prints(min_words: int):
    """Arrow function: text to its lines with a word; `sim` is null for those not compared."""

    @F.arrow_udf(LINE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = WordLanes()
        for batch in batches:
            each = [normalised(text or "") for text in batch.to_pylist()]
            found = [line for lines in each for line in lines]
            digests = _digests([line for _, _, line in found])
            _, once, same = np.unique(digests[:, 0], return_index=True, return_inverse=True)
            made = [features(found[i][1], found[i][2], min_words) for i in once]
            short = np.array([f is None for f in made], bool)
            sims = np.zeros(len(made), np.int64)
            sims[~short] = simhashes([f for f in made if f is not None], cache).view(np.int64)
            chars = np.array([len(found[i][2].decode()) for i in once], np.int32)
            fields = [
                pa.array([no for no, _, _ in found], pa.int32()),
                pa.array(digests[:, 0].copy()),
                pa.array(digests[:, 1].copy()),
                pa.array(sims[same], mask=short[same]),
                pa.array(chars[same]),
            ]
            offsets = np.concatenate(([0], np.cumsum([len(lines) for lines in each]))).astype(np.int32)
            values = pa.StructArray.from_arrays(fields, names=["no", "h1", "h2", "sim", "chars"])
            yield pa.ListArray.from_arrays(offsets, values)

    return run


def block_count(lines: int) -> int:
    """Blocks whose keys are shared by a few percent of so many lines by chance."""
    return next((blocks for most, blocks in MOST_LINES if lines <= most), 7)


def block_keys(sim: str, blocks: int):
    """An array of keys; two SimHashes within the distance have at least one in common.

    Bits that differ are in `DISTANCE` blocks at most, so all others agree: one key for each choice
    of these, of their bits and the choice's number.
    """
    sizes = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    parts = [F.shiftrightunsigned(sim, sum(sizes[:i])).bitwiseAND((1 << n) - 1) for i, n in enumerate(sizes)]
    keys = []
    for k, chosen in enumerate(combinations(range(blocks), blocks - DISTANCE)):
        key = parts[chosen[0]]
        for i in chosen[1:]:
            key = F.shiftleft(key, sizes[i]).bitwiseOR(parts[i])
        keys.append(F.shiftleft(key, 6).bitwiseOR(F.lit(k).cast("bigint")))
    return F.array(*keys)


@F.arrow_udf(T.StringType())
def without_lines(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """Texts without the lines of these numbers."""
    out = []
    for text, numbers in zip(texts.cast(pa.binary()).to_pylist(), gone.to_pylist()):
        if text is not None:
            numbers = set(numbers)
            text = b"\n".join([line for i, line in enumerate(text.split(b"\n")) if i not in numbers])
        out.append(text)
    return pa.array(out, pa.binary()).view(pa.string())


def wanted_lines(documents, lines):
    """Arrow function: (document's hash, text) to those of its normalised lines that are wanted.

    Only a document whose hash is wanted is looked into.
    """

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("h1", T.LongType()), T.StructField("line", T.StringType())])))
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("h1", pa.int64()), ("line", pa.string())]))
        for keys, texts in batches:
            out = []
            for take, text in zip(may_have(documents.value, keys.to_numpy(zero_copy_only=False)), texts):
                norm = [line for _, _, line in normalised(text.as_py() or "")] if take else []
                h1 = _digests(norm)[:, 0]
                chosen = np.flatnonzero(may_have(lines.value, h1))
                out.append([{"h1": int(h1[i]), "line": norm[i].decode()} for i in chosen])
            yield pa.array(out, kind)

    return run


def edit_distance(a: str, b: str, most: int) -> int:
    """Edits that turn one text into the other, or more than `most`.

    Common ends are cut off; the rest is computed a column at a time, all rows of it in
    the bits of two integers.
    """
    lo, hi = 0, min(len(a), len(b))
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    a, b = a[lo:], b[lo:]
    end = 0
    while end < min(len(a), len(b)) and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not a or not b or abs(len(a) - len(b)) > most:
        return max(len(a), len(b))
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    every, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, found = every, 0, len(a)
    for left, c in zip(range(len(b) - 1, -1, -1), b):
        match = places.get(c, 0)
        same = match | down
        cross = (((match & up) + up) ^ up) | match
        more = down | (every & ~(cross | up))
        less = up & cross
        found += bool(more & top) - bool(less & top)
        if found - left > most:
            return most + 1
        more = more << 1 | 1
        up = ((less << 1) | (every & ~(same | more))) & every
        down = more & same & every
    return found


def similar(min_percent: int):
    """Arrow function: whether two lines' edit similarity is at least `min_percent` percent."""

    @F.arrow_udf(T.BooleanType())
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(left.to_pylist(), right.to_pylist()):
            longest = max(len(a), len(b))
            most = (100 - min_percent) * longest // 100
            out.append(edit_distance(a, b, most) <= most)
        return pa.array(out, pa.bool_())

    return run


@F.arrow_udf(T.ArrayType(T.LongType()))
def parted(path: pa.Array, sim: pa.Array, varies: pa.Array) -> pa.Array:
    """Four paths of a SimHash: its path, with each of four parts of the bits in `varies`."""
    path, sim, varies = (x.to_numpy(zero_copy_only=False).view(np.uint64) for x in (path, sim, varies))
    on = (varies[:, None] >> BITS) & np.uint64(1)
    part = np.cumsum(on, axis=1, dtype=np.uint64) % np.uint64(4)
    out = np.empty((len(sim), 4), np.uint64)
    for q in range(4):
        mask = ((on * (part == q)) << BITS).sum(1, dtype=np.uint64)
        out[:, q] = mixed(mixed(path + np.uint64(q)) + mixed(sim & mask))
    flat = pa.array(out.reshape(-1).view(np.int64))
    return pa.ListArray.from_arrays(np.arange(0, 4 * len(sim) + 1, 4, dtype=np.int32), flat)


def _grams(line: str, size: int) -> np.ndarray:
    """Counts of the line's character n-grams in 64 classes."""
    codes = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64)
    codes = window_hashes(codes, size) & np.uint64(63)
    return np.bincount(codes.astype(np.int64), minlength=64).astype(np.int32)


def tile_edges(min_percent: int):
    """Arrow function: a tile pair's lines to similar pairs that tie its groups together.

    An edit changes at most one character and two pairs of neighbours, each to another: so
    counts that are further apart spare the edit distance, as does a group known already.
    """

    def run(tile: pa.Table) -> pa.Table:
        ids, texts = tile["id"].to_pylist(), tile["line"].to_pylist()
        sims = tile["sim"].to_numpy().view(np.uint64)
        slots, other = tile["slot"].to_numpy(), tile["t"][0].as_py()
        left = np.flatnonzero(slots == tile["s"][0].as_py())
        right = np.flatnonzero(slots == other)
        chars = np.array(list(map(len, texts)), np.int64)
        ones, twos = (np.array([_grams(x, n) for x in texts]) for n in (1, 2))
        group = np.unique(tile["comp"].to_numpy(), return_inverse=True)[1]
        a, b = [], []
        for i in left:
            js = right[right > i] if tile["s"][0].as_py() == other else right
            js = js[(group[js] != group[i]) & (np.bitwise_count(sims[js] ^ sims[i]) <= DISTANCE)]
            longest = np.maximum(chars[js], chars[i])
            most = (100 - min_percent) * longest // 100
            js, most = (x[longest - np.minimum(chars[js], chars[i]) <= most] for x in (js, most))
            js, most = (x[np.abs(ones[js] - ones[i]).sum(1) <= 2 * most] for x in (js, most))
            js, most = (x[np.abs(twos[js] - twos[i]).sum(1) <= 4 * most] for x in (js, most))
            for j, k in zip(js.tolist(), most.tolist()):
                if group[j] != group[i] and edit_distance(texts[i], texts[j], k) <= k:
                    group[group == group[j]] = group[i]
                    a.append(min(ids[i], ids[j])), b.append(max(ids[i], ids[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 5,
    min_percent: int = 80,
    leaf: int = 64,
) -> DataFrame:
    """Every row of `docs` with `text` cleaned, `n_lines`, and `n_removed`, the lines taken out.

    Every line with a word takes part with its equals; lines of `min_words` words and more, or
    of as many runs of `RUN` characters, also with similar ones. A line goes if an
    earlier one of its group is in a document of a smaller id, or earlier in its own. Null
    ids come last. Rows that repeat an id are ordered by the hash of their texts; rows alike
    in both count as one document and keep or lose the same lines. A null text stays null
    and has no lines. A very long text is read whole, by one task; a very long line is one
    line like others. Columns named `n_lines` or `n_removed` are replaced, all others stay
    whatever their names. An empty table stays empty.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    slim = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    place = F.struct(
        F.col("id_").isNull().alias("none"), F.col("id_").alias("id_"), F.col("th").alias("th"), F.col("l.no").alias("no")
    )
    seen = (
        slim.select("id_", F.xxhash64("text_").alias("th"), line_prints(min_words)(F.col("text_")).alias("ls"))
        .select("id_", "th", F.explode("ls").alias("l"))
        .select(place.alias("place"), "l.h1", "l.h2", "l.sim", "l.chars")
    )
    seen = scratch.keep(seen, "seen")
    lines = seen.groupBy("h1", "h2").agg(
        F.min("place").alias("first"), F.min("sim").alias("sim"), F.min("chars").alias("chars"), F.count("*").alias("n")
    )
    lines = scratch.keep(lines, "lines")
    compared = lines.where("sim is not null")
    keys = block_keys("sim", block_count(compared.count()))
    rows = compared.select(F.explode(keys).alias("path"), F.col("h1").alias("id"), "sim", "chars")

    def near(a: str, b: str):
        far = F.bit_count(F.col(f"{a}.sim").bitwiseXOR(F.col(f"{b}.sim")))
        m, n = F.col(f"{a}.chars"), F.col(f"{b}.chars")
        return (far <= DISTANCE) & (100 * F.least(m, n) >= min_percent * F.greatest(m, n))

    texts: list[DataFrame] = []

    def prepare(found: DataFrame, large: DataFrame) -> None:
        asked = found.select(F.explode(F.array("a", "b")).alias("id")).unionByName(large.select("id"))
        first = lines.join(asked, lines["h1"] == asked["id"], "left_semi")
        first = first.select(F.xxhash64("first.id_", "first.th").alias("doc"))
        pick = wanted_lines(key_filter(first, "doc"), key_filter(asked, "id"))
        place_of = F.xxhash64("id_", F.xxhash64("text_"))
        made = slim.select(F.explode(pick(place_of, F.col("text_"))).alias("l")).select("l.*")
        whole = made.groupBy("h1").agg(F.min("line").alias("line"))
        texts.append(scratch.keep(whole, "texts"))

    def verify(pairs: DataFrame) -> DataFrame:
        left = texts[0].select(F.col("h1").alias("a"), F.col("line").alias("x"))
        right = texts[0].select(F.col("h1").alias("b"), F.col("line").alias("y"))
        both = pairs.join(left, "a").join(right, "b")
        return both.withColumn("same", similar(min_percent)("x", "y")).where("same").select("a", "b")

    def finish(open_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Nodes still to be split, and the edges of all others.

        Every pair of lines of a small node, or of one whose SimHashes differ in few bits, is
        compared, in tiles of bounded size. Nodes of the same few SimHashes are one.
        """
        ends = open_rows.groupBy("path").agg(F.bit_and("sim").alias("low"), F.bit_or("sim").alias("high"))
        known = open_rows.join(ends, "path").withColumn("varies", F.col("low").bitwiseXOR(F.col("high")))
        alike = F.bit_count("varies") <= ALIKE_BITS
        over = alike | (F.col("in_node") <= TILE)
        node = F.when(alike, F.xxhash64("low", "high")).otherwise(F.col("path")).alias("node")
        done = scratch.keep(known.where(over).select(node, "id", "sim", "comp").distinct(), "alike")
        tiles = done.groupBy("node").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
        dealt = done.join(tiles, "node").withColumn("slot", F.pmod(F.xxhash64("id"), "tiles"))
        dealt = dealt.join(texts[0].withColumnRenamed("h1", "id"), "id")
        dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)))
        dealt = dealt.select("node", F.least("slot", "with").alias("s"), F.greatest("slot", "with").alias("t"), "slot", "id", "sim", "comp", "line")
        edges = scratch.keep(dealt.groupBy("node", "s", "t").applyInArrow(tile_edges(min_percent), "a bigint, b bigint"), "edges")
        return scratch.keep(known.where(~over).drop("low", "high"), "split"), edges

    def branch(open_rows: DataFrame, level: int) -> DataFrame:
        """Each path once for each of four parts of the bits in which its lines differ.

        Two lines within the distance agree on at least one of any four disjoint parts.
        """
        paths = F.explode(parted("path", "sim", "varies"))
        return open_rows.select(paths.alias("path"), "id", "sim", "chars")

    bounds = [F.bit_xor("sim").alias("differ"), F.min("chars").alias("shortest"), F.max("chars").alias("longest")]
    far = (F.bit_count("differ") > DISTANCE) | (100 * F.col("shortest") < min_percent * F.col("longest"))
    hopeless = (bounds, (F.col("in_node") == 2) & far)
    stars = Linker(near, verify, branch, scratch, leaf, finish=finish, hopeless=hopeless).run(rows, prepare)
    owners = lines.select(F.col("h1").alias("id"), "h1", "h2", "first", "n")
    if stars is None:
        groups = owners.select("h1", "h2", "first", "n")
    else:
        tied = owners.join(stars, "id", "left").withColumn("group", F.coalesce("label", "id"))
        least = tied.where("label is not null").groupBy("label").agg(F.min("first").alias("least"), F.sum("n").alias("all"))
        roots = owners.join(least.withColumnRenamed("label", "id"), "id", "left")
        by_label = roots.select("id", "least", "all", "first", "h1", "h2", "n")
        # A root's own first place counts too; then every line learns its group's.
        best = by_label.select(
            F.col("id").alias("group"), F.least("least", "first").alias("best"), (F.coalesce("all", F.lit(0)) + F.col("n")).alias("total")
        )
        groups = tied.join(best, "group").select("h1", "h2", F.col("best").alias("first"), F.col("total").alias("n"))
    repeated = groups.where("n > 1").select("h1", "h2", "first")
    gone = (
        seen.select("place", "h1", "h2")
        .join(repeated, ["h1", "h2"])
        .where("place <> first")
        .groupBy("place.id_", "place.th")
        .agg(F.collect_set("place.no").alias("gone"))
    )
    rows = docs.drop("n_lines", "n_removed")
    g = unused("gone", rows)
    gone = scratch.keep(gone.select(F.struct("id_", "th", "gone").alias(g)), "gone")
    same = F.col(id_col).eqNullSafe(F.col(f"{g}.id_")) & (F.xxhash64(text_col) == F.col(f"{g}.th"))
    rows = rows.join(gone, same, "left")
    gone = F.col(f"{g}.gone")
    text = F.col(text_col)
    cleaned = F.when(gone.isNull(), text).otherwise(without_lines(F.when(gone.isNotNull(), text), gone))
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return rows.withColumns(
        {
            text_col: cleaned,
            "n_lines": F.when(text.isNull(), 0).otherwise(breaks + 1).cast("bigint"),
            "n_removed": F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("bigint"),
        }
    ).drop(g)
