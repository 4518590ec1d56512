"""Benchmark questions found in documents even if their numbers and names were exchanged.

Both sides become templates: a number is `<number>`, a unit of measure behind it `<unit>`,
a run of words with a capital letter `<name>`; other words are in lower case, without
punctuation at their ends; in scripts without spaces each character is one. Windows of `WINDOW` template words are hashed and joined. A
window with fewer than two plain words says too little and is left out.

Where nearly all words have a capital letter (`RUN` words and more, titles and capitals) it
tells no names: such a passage gets a second template in which words with capitals are plain,
and so does every item with a name. An item none of whose windows says enough is found
verbatim but for case and punctuation, by all of its words at once.

A document holds an item if at least `min_percent` percent of the item's windows lie in it
at one offset, give or take `DRIFT` words, and if the names are consistent: at least
`slot_percent` percent of the names in the item's matched slots are exchanged for the same
name wherever they occur. A verbatim passage exchanges every name for itself. Numbers and
units are judged place by place: one number may have several roles in an item.

Only documents that have one of an item's rarest windows are compared with it: an item of
n windows of which m must be found cannot be held without one of any n - m + 1 of them. So
a window that many items share brings no pairs together.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import Scratch, WordHashes, key_filter, may_have, mixed, window_hashes

WINDOW = 5
DRIFT = 8
RUN = 5
CAPITALS = 3  # a run has so many words with a capital letter at least
NUMBER, NAME, UNIT = b"<number>", b"<name>", b"<unit>"
EDGES = b".,;:!?\"'()[]{}<>*#%&$|-_/"
# Units of measure that follow a number.
UNITS = frozenset(
    b"mm cm m km in ft yd mi mg g kg t oz lb ml l gal s sec second seconds min minute minutes "
    b"h hour hours day days week weeks month months year years cent cents dollar dollars euro "
    b"euros pound pounds inch inches foot feet yard yards mile miles meter meters kilometer "
    b"kilometers gram grams kilogram kilograms liter liters percent degree degrees".split()
)
# Words that are no names even with a capital letter.
PLAIN = frozenset(
    b"a an and are as at be by can do does each every find for from give given has have he her his how "
    b"i if in is it its let many much no not of on one or she so that the their then there they this to "
    b"was we were what when where which who why will with you your "
    b"ce de der des die du el en et il in la las le les los que qui si un una und une von wenn wie".split()
)
# Chinese, Japanese, Thai, Lao, Tibetan, Burmese and Khmer characters, and their punctuation.
_UNSPACED = re.compile("([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
_WIDE = re.compile("[\u2018-\u201f\u2026\u3000-\u3004\u3008-\u303f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
_S = T.StructField
SLOT = T.StructType([_S("place", T.IntegerType()), _S("value", T.StringType()), _S("name", T.BooleanType())])
WINDOWS = T.ArrayType(
    T.StructType([_S("version", T.IntegerType()), _S("h", T.LongType()), _S("at", T.IntegerType()), _S("slots", T.ArrayType(SLOT))])
)
PATTERN, CASELESS, WHOLE = 0, 1, 2  # versions of an item


class Words(dict):
    """What each written word is in a template; remembers a bounded number.

    (kind or word, value, lower case, mark): the mark is 2 for a word with a capital letter,
    1 for one that may stand among such words, 0 for any other.
    """

    LIMIT = 100_000

    def __missing__(self, raw: bytes) -> tuple[bytes, bytes, bytes, int]:
        bare = raw.strip(EDGES)
        if not bare:
            out = (b"", b"", b"", 1)
        elif bare[:1].isdigit():
            out = (NUMBER, bare, bare.lower(), 1)
        else:
            text = bare.decode()
            low = text.lower().encode()
            upper = text[0].isupper()
            kind, value = (NAME, low) if upper and low not in PLAIN else (low, b"")
            out = (kind, value, low, 2 if upper else int(low in PLAIN or not text[0].isalpha()))
        if len(self) < self.LIMIT:
            self[raw] = out
        return out


def written(text: str, words: Words) -> list[tuple[bytes, bytes, bytes, int]]:
    """The text's words as `Words` has them."""
    if not text.isascii():
        text = _UNSPACED.sub(r" \1 ", _WIDE.sub(" ", text))
    return list(map(words.__getitem__, text.encode().split()))


def template(parts: list[tuple[bytes, bytes, bytes, int]], names: bool = True) -> tuple[list[bytes], list[bytes]]:
    """Template words and their values (empty for a plain word); without `names` these are plain."""
    kinds: list[bytes] = []
    values: list[bytes] = []
    for kind, value, low, _ in parts:
        if not kind:
            continue
        if kind == NAME and not names:
            kind, value = low, b""
        if kind == NAME and kinds and kinds[-1] == NAME:
            values[-1] += b" " + value
        elif kinds and kinds[-1] == NUMBER and kind in UNITS:
            kinds.append(UNIT), values.append(kind)
        else:
            kinds.append(kind), values.append(value)
    return kinds, values


def capital_runs(parts: list[tuple[bytes, bytes, bytes, int]]) -> list[tuple[int, int]]:
    """Where runs of words with capital letters begin and end."""
    mark = np.array([p[3] for p in parts], np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mark > 0, [0]))))
    upper = np.concatenate(([0], np.cumsum(mark == 2)))
    begin, end = edges[::2], edges[1::2]
    take = (end - begin >= RUN) & (upper[end] - upper[begin] >= CAPITALS)
    return list(zip(begin[take].tolist(), end[take].tolist()))


def telling(kinds: list[bytes], values: list[bytes], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a template's windows that say enough, and their places."""
    if len(kinds) < WINDOW:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = window_hashes(cache.of(kinds), WINDOW)
    plain = np.concatenate(([0], np.cumsum([not v for v in values])))
    at = np.flatnonzero(plain[WINDOW:] - plain[:-WINDOW] >= 2)
    return h[at], at


def versions(parts: list[tuple[bytes, bytes, bytes, int]], cache: WordHashes):
    """(hashes, places, kinds, values) of the windows of a text and, behind them, of its capital runs."""
    kinds, values = template(parts)
    h, at = telling(kinds, values, cache)
    for begin, end in capital_runs(parts):
        more, theirs = template(parts[begin:end], names=False)
        g, places = telling(more, theirs, cache)
        # Further from all others than a drift.
        gap = 2 * DRIFT
        h, at = np.concatenate((h, g)), np.concatenate((at, places + len(kinds) + gap))
        kinds, values = kinds + [b""] * gap + more, values + [b""] * gap + theirs
    return h, at, kinds, values


def template_windows(text: str, words: Words, cache: WordHashes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Hashes of the windows that say enough, their places, and all slot values."""
    h, at, _, values = versions(written(text, words), cache)
    return h, at, values


def spans(h: np.ndarray, size: int) -> np.ndarray:
    """One hash per `size` neighbouring words, whatever the size, other than any window's."""
    if len(h) < size:
        return np.empty(0, np.uint64)
    factor = 0x9E3779B97F4A7C15
    one = np.ones(1, np.uint64)
    powers = np.concatenate((one, np.cumprod(np.full(len(h) - 1, factor, np.uint64))))
    back = np.concatenate((one, np.cumprod(np.full(len(h) - 1, pow(factor, -1, 1 << 64), np.uint64))))
    sums = np.concatenate((one - one, np.cumsum(mixed(h) * back)))
    n = len(h) - size + 1
    salt = np.uint64(size * 0xD6E8FEB86659FD93 % 2**64)
    return mixed((sums[size:] - sums[:n]) * powers[:n] + salt)


def _rows(version: int, h: np.ndarray, at: np.ndarray, kinds: list[bytes], values: list[bytes]) -> list[dict]:
    return [
        {
            "version": version,
            "h": x,
            "at": i,
            "slots": [{"place": k, "value": values[k].decode(), "name": kinds[k] == NAME} for k in range(i, i + WINDOW) if values[k]],
        }
        for x, i in zip(h.view(np.int64).tolist(), at.tolist())
    ]


def item_windows(text: str, words: Words, cache: WordHashes) -> list[dict]:
    """Windows of the versions in which an item is looked for."""
    parts = written(text, words)
    kinds, values = template(parts)
    h, at = telling(kinds, values, cache)
    out = _rows(PATTERN, h, at, kinds, values)
    if NAME in kinds:
        more, theirs = template(parts, names=False)
        out += _rows(CASELESS, *telling(more, theirs, cache), more, theirs)
    low = [p[2] for p in parts if p[2]]
    if not len(h) and low:
        whole = int(spans(cache.of(low), len(low)).view(np.int64)[0])
        out.append({"version": WHOLE, "h": whole, "at": 0, "slots": [], "size": len(low)})
    return out


def windows_of(wanted=None, sizes: tuple[int, ...] = ()):
    """Arrow function: an item's windows; or those of a text whose hash is wanted.

    A text also has a window for each of `sizes` neighbouring words, the sizes of whole items.
    """
    fields = WINDOWS if wanted is not None else T.ArrayType(T.StructType([*WINDOWS.elementType.fields, _S("size", T.IntegerType())]))

    @F.arrow_udf(fields)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, cache = Words(), WordHashes()
        slot = pa.struct([("place", pa.int32()), ("value", pa.string()), ("name", pa.bool_())])
        kind = [("version", pa.int32()), ("h", pa.int64()), ("at", pa.int32()), ("slots", pa.list_(slot))]
        if wanted is None:
            for batch in batches:
                out = [item_windows(text or "", words, cache) for text in batch.to_pylist()]
                yield pa.array(out, pa.list_(pa.struct([*kind, ("size", pa.int32())])))
            return
        keys = wanted.value
        for batch in batches:
            out = []
            for text in batch.to_pylist():
                parts = written(text or "", words)
                h, at, kinds, values = versions(parts, cache)
                take = may_have(keys, h)
                found = _rows(PATTERN, h[take], at[take], kinds, values)
                low = cache.of([p[2] for p in parts if p[2]]) if sizes else ()
                for size in sizes:
                    g = spans(low, size)
                    places = np.flatnonzero(may_have(keys, g))
                    whole = zip(g[places].view(np.int64).tolist(), places.tolist())
                    found += [{"version": WHOLE, "h": x, "at": i, "slots": []} for x, i in whole]
                out.append(found)
            yield pa.array(out, pa.list_(pa.struct(kind)))

    return run


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    min_percent: int = 80,
    slot_percent: int = 90,
) -> DataFrame:
    """(id, text_hash, item, found, windows, exchanged): each document that holds an item.

    `found` of the item's `windows` lie in the document; `exchanged` says whether a slot
    has another value there. `text_hash` is xxhash64 of the text. Items that repeat an id
    or a text are judged one by one and listed under their id once. An item without a
    window that says enough (fewer than five words, say) is one window of all its words. Null and
    empty texts hold nothing; null ids are ids. A document that holds an item several times
    is listed once for it. Other columns are not looked at; empty tables give no rows.
    """
    scratch = Scratch(docs.sparkSession, "templates")
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text_"))
    items = items.withColumn("key", F.xxhash64("item", "text_")).dropDuplicates(["key"])
    asked = items.select("item", "key", F.explode(windows_of()(F.col("text_"))).alias("w")).select("item", "key", "w.*")
    asked = scratch.keep(asked.withColumn("key", F.xxhash64("key", "version")), "asked")
    sizes_asked = asked.where("size is not null").select("size").distinct().toArrow()["size"].to_pylist()  # one line per length
    counted = asked.groupBy("key", "h").agg(F.count("*").alias("in_item"))
    spread = counted.groupBy("h").agg(F.count("*").alias("items"))
    rank = Window.partitionBy("key").orderBy("items", "h")
    ranked = counted.join(spread, "h").withColumn("rank", F.row_number().over(rank))
    sizes = counted.groupBy("key").agg(F.count("*").cast("int").alias("windows"))
    needed = F.expr(f"({min_percent} * windows + 99) div 100")
    rare = ranked.join(sizes, "key").where(F.col("rank") <= F.col("windows") - needed + 1).select("h", "key")
    rare = scratch.keep(rare, "rare")

    rows = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    wanted = key_filter(asked.select("h"), "h")
    hits = rows.select("id_", F.xxhash64("text_").alias("th"), F.explode(windows_of(wanted, tuple(sizes_asked))(F.col("text_"))).alias("w"))
    hits = hits.select("id_", "th", F.xxhash64("id_", "th").alias("doc"), "w.*").join(asked.select("h").distinct(), "h", "left_semi")
    hits = scratch.keep(hits, "hits")
    pairs = scratch.keep(hits.join(rare, "h").select("doc", "key").distinct(), "pairs")
    theirs = asked.select("item", "key", "h", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    met = hits.join(pairs.join(theirs, "key"), ["doc", "h"])
    # Offsets within `DRIFT` of each other share one of two overlapping bins.
    step = F.floor((F.col("at") - F.col("item_at")) / DRIFT)
    met = met.withColumn("bin", F.explode(F.array(step, step + 1)))
    group = ["id_", "th", "item", "key", "bin"]
    held = (
        met.groupBy(*group)
        .agg(F.count_distinct("h").alias("found"))
        .join(sizes, "key")
        .where(100 * F.col("found") >= min_percent * F.col("windows"))
    )
    held = scratch.keep(held, "held")
    same = [met["id_"].eqNullSafe(held["id_"]), met["th"] == held["th"], met["key"] == held["key"], met["bin"] == held["bin"]]
    slots = met.join(held.select("id_", "th", "key", "bin"), same, "left_semi").withColumn(
        "slot", F.explode_outer(F.arrays_zip(F.col("item_slots").alias("was"), F.col("slots").alias("now")))
    )
    # Neighbouring windows show the same slots: each place of the item counts once.
    once = slots.select(
        *group, *[F.col(f"slot.was.{a}").alias(b) for a, b in (("place", "place"), ("name", "name"), ("value", "was"))],
        F.col("slot.now.value").alias("now"),
    ).distinct()
    values = once.groupBy(*group, "name", "was", "now").agg(F.count("*").alias("n"))
    mapped = values.groupBy(*group, "name", "was").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.max(F.col("was") != F.col("now")).alias("other")
    )
    judged = mapped.groupBy(*group).agg(
        F.sum(F.when(F.col("name"), F.col("n"))).alias("n"),
        F.sum(F.when(F.col("name"), F.col("most"))).alias("most"),
        F.max("other").alias("other"),
    )
    steady = judged.where(F.col("n").isNull() | (100 * F.col("most") >= slot_percent * F.col("n")))
    right = steady.select(*[F.col(c).alias(f"r_{c}") for c in group], "other")
    on = [held[c].eqNullSafe(right[f"r_{c}"]) for c in group]
    out = held.join(right, on).groupBy("id_", "th", "item").agg(
        F.max(F.struct("found", "windows")).alias("most"), F.min(F.coalesce("other", F.lit(False))).alias("exchanged")
    )
    return out.select(F.col("id_").alias(id_col), F.col("th").alias("text_hash"), F.col("item").alias(item_col), "most.found", "most.windows", "exchanged")
