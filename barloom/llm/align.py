"""Alignment of two tokenizers over a corpus, with corpus-wide counts of aligned pairs.

Both tokenizers cut the same bytes. Where a token of each ends at the same byte, the two
are linked, and the text is cut into groups there. How often each pair of ids is linked in
the whole corpus is counted in dense vectors:

1. every text is encoded once by each tokenizer; the ids are written, packed
2. the distinct pairs are gathered and get the numbers of a minimal perfect hash
3. the ids are aligned again; each task counts its links in a vector indexed by that
   hash, and the vectors are summed as a tree
4. the ids are aligned once more, and each link looks up its pair's count

The hash is sent to the tasks in runs of at most `MOST_PAIRS` pairs; steps 3 and 4 are
repeated per run, and results do not depend on the number of runs. Every lookup compares
the key kept under the number with its own.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from barloom.llm import bpe, perfect_hash
from barloom.llm.common import Scratch, shipped
from barloom.llm.trees import folded

MOST_PAIRS = 1 << 21  # pairs of one run; 8 bytes each for key and count, 1 for the hash
CHUNK = 1 << 14  # counts of a vector that travel together
REMEMBERED = 150_000  # parts of texts whose alignment a task remembers, and as many older ones
SHORT = 64  # characters of a part that is remembered
SPACE = "▁"

_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]", "[.,!?%&$#*]"
# Letters up to white space or a mark; marks up to white space; anything up to white space.
_PARTS = re.compile(rf"[ \n]*{_LETTERS}+(?=[ \n]|{_MARKS}|\Z)|{_MARKS}+(?=[ \n]|\Z)|[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile(r"[^\S \n]")
ENCODED = T.StructType(
    [
        T.StructField("a", T.BinaryType()),
        T.StructField("b", T.BinaryType()),
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("groups", T.StringType()),
        T.StructField("groups_sha256", T.StringType()),
    ]
)
VECTORS = "chunk int, part int, counts binary"
FOUND = T.StructType([T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])


def piece_bytes(content: bytes) -> list[bytes]:
    """The bytes of each id of a sentencepiece model; U+2581 stands for a space."""
    model = sentencepiece_model_pb2.ModelProto.FromString(content)
    named = re.compile(r"<0x([0-9A-F]{2})>")
    found = [(p.piece, named.fullmatch(p.piece)) for p in model.pieces]
    return [bytes([int(m[1], 16)]) if m else piece.replace(SPACE, " ").encode() for piece, m in found]


def cuts_at_spaces(content: bytes) -> bool:
    """Whether a text may be encoded in the parts of `_PARTS`.

    So it is if the model leaves the text as it is, puts one space in front, and has no
    piece with a line feed, a space behind another character or a mark behind a letter: no
    merge crosses.
    """
    model = sentencepiece_model_pb2.ModelProto.FromString(content)
    norm = model.normalizer_spec
    plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not norm.remove_extra_whitespaces
    types = {p.type for p in model.pieces}
    own = sentencepiece_model_pb2.ModelProto.SentencePiece.USER_DEFINED in types
    bpe_model = model.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
    crossing = any(re.search(f"[^{SPACE}]{SPACE}|\n|{_LETTERS}{_MARKS}", p.piece) for p in model.pieces)
    return bool(plain and bpe_model and not own and not crossing)


class PieceEncoder:
    """Ids of parts of texts by a sentencepiece model, the text's first space included."""

    def __init__(self, content: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.cuts = cuts_at_spaces(content)
        self.space = self.model.piece_to_id(SPACE)

    def __call__(self, parts: list[str]) -> list[list[int]]:
        # The model puts a space in front. That is the part's own; one without gets a line
        # feed behind it, which joins nothing, and both are taken off again.
        texts = [p[1:] if p[0] == " " else f"\n{p}" for p in parts]
        ids = self.model.encode(texts, num_threads=1) if parts else []
        for i, part in enumerate(parts):
            if part == " ":  # the library makes nothing of nothing
                ids[i] = [self.space]
            elif part[0] != " ":
                del ids[i][:2]
        return ids


class Pair:
    """What both vocabularies are to a task: bytes, lengths and keys of pairs."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = bpe.bytes_of_ids(a), piece_bytes(b)
        self.length_a = np.array([len(x) for x in self.a], np.int64)
        self.length_b = np.array([len(x) for x in self.b], np.int64)
        self.width_a, self.width_b = (2 if len(x) <= 1 << 16 else 4 for x in (self.a, self.b))

    def unpacked(self, a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of several texts in a row, and the number of A's in each."""
        ids = [np.frombuffer(b"".join(x.to_pylist()), f"<u{w}") for x, w in ((a, self.width_a), (b, self.width_b))]
        return *ids, np.array([len(x) // self.width_a for x in a.to_pylist()], np.int64)

    def links(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of A and of B that end together.

        No token is empty, and both sides of each text have as many bytes, so texts in a
        row are aligned like one.
        """
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        at = np.searchsorted(end_b, end_a)
        last_a = np.flatnonzero(end_b[at] == end_a)
        return last_a, at[last_a]

    def keys(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place in A of each link and one number for its pair: A's id, then B's."""
        last_a, last_b = self.links(a, b)
        return last_a, a[last_a].astype(np.uint64) * np.uint64(len(self.b)) + b[last_b].astype(np.uint64)


class Aligner:
    """Ids and groups of texts; equal parts are encoded and aligned once.

    Where both tokenizers may be cut, their tokens end together, so a text's groups are
    those of its parts in a row. Texts with other white space are one part.
    """

    def __init__(self, pair: Pair, a: bytes, b: bytes):
        self.pair, self.ids_a, self.ids_b = pair, bpe.Encoder(a), PieceEncoder(b)
        self.known: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}
        # Each id's digits with what may follow: more of its side, the other side, a group.
        self.ids = max(len(pair.a), len(pair.b))
        self.digits = [f"{i}{end}" for end in ",|;" for i in range(self.ids)]

    def _encoded(self, parts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        short = [p for p in parts if len(p) <= SHORT and not _OTHER_SPACE.search(p)]
        self.ids_a.learn(set(short))
        found = dict(zip(short, map(self.ids_a.known.pop, short)))
        long = [p for p in parts if p not in found]
        found.update(zip(long, self.ids_a(long)))
        return [np.frombuffer(found[p], np.int32) for p in parts], [np.array(i, np.int32) for i in self.ids_b(parts)]

    def _learn(self, parts: list[str]) -> None:
        """Encode and align new parts, all of them in a row; None for those not given back."""
        every_a, every_b = self._encoded(parts)
        tables = (self.pair.a, every_a), (self.pair.b, every_b)
        whole = "".join(parts).encode()
        if any(b"".join(map(table.__getitem__, np.concatenate(ids).tolist())) != whole for table, ids in tables):
            for i, part in enumerate(parts):
                if any(b"".join([table[t] for t in ids[i]]) != part.encode() for table, ids in tables):
                    self.known[part] = None
            good = [i for i, part in enumerate(parts) if part not in self.known]
            if not good:
                return
            parts, every_a, every_b = ([x[i] for i in good] for x in (parts, every_a, every_b))
        a, b = np.concatenate(every_a), np.concatenate(every_b)
        last_a, last_b = self.pair.links(a, b)
        ends_a, ends_b = (np.cumsum([len(i) for i in ids]) for ids in (every_a, every_b))
        group = np.concatenate([np.searchsorted(last_a, np.arange(len(a))), np.searchsorted(last_b, np.arange(len(b)))])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        ids, side, group = np.concatenate([a, b])[order], side[order], group[order]
        follows = np.full(len(ids), 2)
        follows[:-1] = np.where(group[1:] != group[:-1], 2, side[1:] != side[:-1])
        written = list(map(self.digits.__getitem__, (ids + follows * self.ids).tolist()))
        size_a, size_b = self.pair.width_a, self.pair.width_b
        bytes_a, bytes_b = a.astype(f"<u{size_a}").tobytes(), b.astype(f"<u{size_b}").tobytes()
        links = np.searchsorted(last_a, ends_a).tolist()
        i = j = n = 0
        for part, end_a, end_b, link in zip(parts, ends_a.tolist(), ends_b.tolist(), links):
            groups = "".join(written[i + j : end_a + end_b])
            self.known[part] = bytes_a[i * size_a : end_a * size_a], bytes_b[j * size_b : end_b * size_b], link - n, groups
            i, j, n = end_a, end_b, link

    def __call__(self, texts: list[str]) -> Iterator[tuple | None]:
        """The columns of each text in turn; None for one without tokens."""
        cut = []
        for text in texts:
            if not text:
                cut.append([])
            elif self.ids_b.cuts and not _OTHER_SPACE.search(text):
                cut.append(_PARTS.findall(f" {text}"))
            else:
                cut.append([f" {text}"])
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        missing = set(chain.from_iterable(cut)).difference(self.known)
        again = missing.intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        new = list(missing.difference(again))
        if new:
            self._learn(new)
        for parts in cut:
            found = list(map(self.known.__getitem__, parts))
            if not found or None in found:
                yield None
                continue
            a, b, links, groups = zip(*found)
            yield b"".join(a), b"".join(b), sum(links), "".join(groups)[:-1]
        for part in new:
            if len(part) > SHORT:
                del self.known[part]


def _encoder(packed_a, packed_b, with_groups: bool):
    @F.arrow_udf(ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pair = Pair(packed_a.value, packed_b.value)
        aligned = Aligner(pair, packed_a.value, packed_b.value)
        none = (b"", b"", 0, 0, 0, "" if with_groups else None, "")
        for batch in batches:
            out = []
            for found in aligned([t or "" for t in batch.to_pylist()]):
                if found is None:
                    out.append(none)
                    continue
                a, b, links, groups = found
                digest = hashlib.sha256(groups.encode()).hexdigest()
                out.append((a, b, len(a) // pair.width_a, len(b) // pair.width_b, links, groups if with_groups else None, digest))
            columns = zip(*out) if out else [()] * len(ENCODED)
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FIELDS)], fields=_FIELDS)

    return run


_FIELDS = [
    *[pa.field(n, pa.binary()) for n in ("a", "b")],
    *[pa.field(n, pa.int64()) for n in ("n_a", "n_b", "n_groups")],
    *[pa.field(n, pa.string()) for n in ("groups", "groups_sha256")],
]


def _pairs(packed_a, packed_b):
    """Arrow function: packed ids to the distinct pairs linked in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, held = Pair(packed_a.value, packed_b.value), np.empty(0, np.uint64)
        for batch in batches:
            a, b, _ = pair.unpacked(*batch.columns)
            held = np.union1d(held, pair.keys(a, b)[1])
            if len(held) > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64))], ["key"])
                held = held[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64))], ["key"])

    return run


def _counter(packed_a, packed_b, run_of):
    """Arrow function: packed ids to the chunks of one dense vector of counts a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, (hashed, keys) = Pair(packed_a.value, packed_b.value), run_of.value
        counts = np.zeros(-(-hashed.n // CHUNK) * CHUNK, np.int64)
        for batch in batches:
            a, b, _ = pair.unpacked(*batch.columns)
            number = _numbers(hashed, keys, pair.keys(a, b)[1])[1]
            counts += np.bincount(number, minlength=len(counts))
        part = TaskContext.get().partitionId()
        for i, chunk in enumerate(counts.reshape(-1, CHUNK)):
            if chunk.any():
                columns = [pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([chunk.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "part", "counts"])

    return run


def _numbers(hashed: perfect_hash.PerfectHash, keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted keys this run has, and the number of each of those."""
    number = hashed.numbers(wanted)
    mine = number >= 0
    mine[mine] = keys[number[mine]] == wanted[mine]
    return mine, number[mine]


def _summed(group: pa.Table) -> pa.Table:
    total = np.zeros(CHUNK, np.int64)
    for counts in group.column("counts"):
        total += np.frombuffer(counts.as_buffer(), np.int64)
    first = group.slice(0, 1)
    return pa.table([first.column("chunk"), first.column("part"), pa.array([total.tobytes()], pa.binary())], ["chunk", "part", "counts"])


def _finder(packed_a, packed_b, run_of, best):
    @F.arrow_udf(FOUND)
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pair, (hashed, keys, counts), most = Pair(packed_a.value, packed_b.value), run_of.value, best.value
        for left, right in batches:
            a, b, sizes = pair.unpacked(left, right)
            place, wanted = pair.keys(a, b)
            mine, number = _numbers(hashed, keys, wanted)
            count = counts[number]
            highest = count == most[(wanted[mine] % np.uint64(len(most))).astype(np.int64)]
            ends = np.searchsorted(place[mine], np.cumsum(sizes))  # links of the texts so far
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[ends], prepend=0) for x in (highest, count)]
            yield pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in sums], ["n_best", "count_sum"])

    return run


def alignments(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    text_col: str = "text",
    keep: list[str] | None = None,
    with_groups: bool = False,
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """Every row with the counts of its alignment between tokenizers A and B.

    A is a byte-level tokenizer's JSON, B a sentencepiece model; A gets the text with the
    space in front that B puts there. Special tokens are never made, their strings are
    ordinary text. New columns: n_a and n_b (tokens), n_groups and n_links, n_best (links
    whose pair no other pair of the same B id exceeds in the whole corpus, ties included),
    count_sum (the corpus-wide counts of all links), groups_sha256, and with `with_groups`
    also groups, the text `a1,a2|b1;a3|b2,b3`.

    `keep` names the columns of `docs` that stay, by default all; one with a new column's
    name is replaced. A null or empty text, or one whose bytes a tokenizer does not give
    back, has no tokens: zeros and ''. Rows that are repeated count as often as they are
    there and all come back; an empty table stays empty. Texts of any length are encoded
    whole, those of millions of characters too.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "align")
    with open(path_a, "rb") as file_a, open(path_b, "rb") as file_b:
        packed_a, packed_b = shipped(spark, file_a.read(), path_a), shipped(spark, file_b.read(), path_b)

    names = docs.columns if keep is None else keep
    encoded = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), _encoder(packed_a, packed_b, with_groups)(F.col(f"`{text_col}`")).alias("t")
    )
    rows = scratch.keep(encoded.select("row", "t.*"), "ids", compression="zstd")
    ids = rows.where("n_a > 0").select("a", "b")
    pairs = scratch.keep(ids.mapInArrow(_pairs(packed_a, packed_b), "key bigint").distinct(), "pairs")
    n_pairs = pairs.count()
    size_b = len(piece_bytes(packed_b.value))
    best, runs = np.zeros(size_b, np.int64), []
    if n_pairs:
        made = scratch.keep(perfect_hash.build(pairs, n_pairs), "hash")
        for first, end in perfect_hash.ranges(made, most_pairs):
            hashed, keys = perfect_hash.loaded(made, first, end, n_pairs)
            run_of = spark.sparkContext.broadcast((hashed, keys))
            vectors = ids.mapInArrow(_counter(packed_a, packed_b, run_of), VECTORS)
            summed = folded(vectors, _summed, scratch, "counts", keys=("chunk",))
            counts = _dense(summed, hashed.n)
            np.maximum.at(best, (keys % np.uint64(size_b)).astype(np.int64), counts)
            runs.append((first, end, summed))
            run_of.unpersist()

    highest = spark.sparkContext.broadcast(best)
    found = rows.withColumns({"n_best": F.lit(0).cast("bigint"), "count_sum": F.lit(0).cast("bigint")})
    for i, (first, end, summed) in enumerate(runs):
        hashed, keys = perfect_hash.loaded(made, first, end, n_pairs)
        run_of = spark.sparkContext.broadcast((hashed, keys, _dense(summed, hashed.n)))
        more = found.withColumn("more", _finder(packed_a, packed_b, run_of, highest)("a", "b"))
        found = more.withColumns({c: F.col(c) + F.col(f"more.{c}") for c in ("n_best", "count_sum")}).drop("more")
        if i < len(runs) - 1:
            found = scratch.keep(found, "found", compression="zstd")
    new = {
        "n_a": F.col("n_a"), "n_b": F.col("n_b"), "n_groups": F.col("n_groups"), "n_links": F.col("n_groups"),
        "n_best": F.col("n_best"), "count_sum": F.col("count_sum"), "groups_sha256": F.col("groups_sha256"),
    }
    if with_groups:
        new["groups"] = F.col("groups")
    kept = [F.col(f"row.`{c}`").alias(c) for c in names if c not in new]
    return found.select(*kept, *[value.alias(name) for name, value in new.items()])


def _dense(summed: DataFrame, n: int) -> np.ndarray:
    """The counts of one run by number; at most `MOST_PAIRS` of them."""
    counts = np.zeros(-(-n // CHUNK) * CHUNK, np.int64)
    for row in summed.toArrow().to_pylist():
        counts[row["chunk"] * CHUNK :][:CHUNK] = np.frombuffer(row["counts"], np.int64)
    return counts[:n]
