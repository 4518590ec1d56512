"""Byte-level BPE encoding and decoding by a file of token ranks.

The ranks become a model of the `tokenizers` library: bytes are written as the printable
characters of the byte table, and the merge of each token is found by merging its own
bytes with the tokens of lower rank, which ends in two parts. That gives the same ids as
merging any two neighbours whose joined bytes have the lowest rank: two neighbours whose
bytes make a token and that no merge crosses were made by the same merges as in that
token alone.

Offsets come from the byte lengths of the tokens: a token covers every character of which
it holds a byte, so two tokens that split a character both cover it. Decoding joins bytes
before anything is read as UTF-8, so split characters come back whole.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from barloom.llm.common import shipped

CHUNK_CHARS = 1 << 20  # characters that are encoded at once
ENCODED = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("ends", T.ArrayType(T.IntegerType())),
    ]
)
# A match of a pattern that starts runs of white space anew never crosses these places.
_CUT = re.compile(r"(?<=\S)[ \n]")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", "[.,!?%&$#*]"
_ONE_WORD = re.compile(f" ?{_LETTERS}")
# Letters up to white space or a mark; marks up to white space; anything up to white space.
_PARTS = re.compile(rf"[ \n]*{_LETTERS}(?=[ \n]|{_MARKS}|\Z)|{_MARKS}+(?=[ \n]|\Z)|[ \n]*[^ \n]+|[ \n]+")


def byte_table() -> list[str]:
    """The character that stands for each byte: itself if it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(prints)]
    table = {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts that make a token, by merging its bytes with tokens of lower rank."""
    parts, own = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1))
        if rank >= own:
            raise ValueError(f"token {own} is not made of two tokens of lower rank")
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


def tokenizer(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """The library's model of a rank file; each match of `pattern` is encoded by itself."""
    table = byte_table()

    def chars(token: bytes) -> str:
        return "".join(table[b] for b in token)

    longer = sorted((t for t in ranks if len(t) > 1), key=ranks.__getitem__)
    merges = [tuple(map(chars, merge_of(t, ranks))) for t in longer]
    model = models.BPE({chars(t): r for t, r in ranks.items()}, merges, ignore_merges=True)
    out = Tokenizer(model)
    out.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return out


def loaded(content: bytes) -> Tokenizer:
    """A tokenizer from its JSON; strings of special tokens are ordinary text to it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
    tok = Tokenizer.from_str(content.decode())
    tok.encode_special_tokens = True
    return tok


def bytes_of_ids(content: bytes) -> list[bytes]:
    """The bytes of each id of a tokenizer's JSON, by the reversed byte table."""
    byte_of = {c: b for b, c in enumerate(byte_table())}
    vocab = json.loads(content)["model"]["vocab"]
    table = [b""] * (max(vocab.values(), default=-1) + 1)
    for chars, i in vocab.items():
        if all(c in byte_of for c in chars):
            table[i] = bytes(byte_of[c] for c in chars)
    return table


def pieces(text: str, size: int = CHUNK_CHARS) -> Iterator[str]:
    """A text in parts of about `size` characters that are encoded as in the whole."""
    start = 0
    while len(text) - start > size and (cut := _CUT.search(text, start + size)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class Encoder:
    """Ids of texts; equal parts of a text are given to the library once.

    A text without other white space than spaces and line feeds is cut where no match of
    the pattern can cross: before white space behind anything else, and between letters and
    the marks behind a word. The library encodes each distinct part; a space and letters
    are one match, which needs no pattern. Any other text goes to the library whole.
    """

    LIMIT = 800_000  # remembered parts, and as many from before

    def __init__(self, content: bytes):
        self.whole, self.word = loaded(content), loaded(content)
        self.word.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers
        self.before: dict[str, bytes] = {}  # parts known earlier; those that come again are taken over

    def learn(self, parts: set[str]) -> None:
        """Encode parts of texts that need no further cutting."""
        met = parts.intersection(self.before)
        self.known.update(zip(met, map(self.before.__getitem__, met)))
        parts.difference_update(met)
        words = [p for p in parts if _ONE_WORD.fullmatch(p)]
        others = list(parts.difference(words))
        for tok, group in ((self.word, words), (self.whole, others)):
            found = tok.encode_batch_fast(group, add_special_tokens=False)
            for part, ids in zip(group, found):
                self.known[part] = array("i", ids.ids).tobytes()

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text in turn, about `CHUNK_CHARS` characters at a time."""
        made: list[bytes] = []
        current = 0
        for group in _groups((i, part) for i, text in enumerate(texts) for part in pieces(text)):
            if len(self.known) > self.LIMIT:
                self.before, self.known = self.known, {}
            cut = [[part] if _OTHER_SPACE.search(part) else _PARTS.findall(part) for _, part in group]
            new = set(filterfalse(self.known.__contains__, chain.from_iterable(cut)))
            long = [part for part in new if len(part) > 64]
            self.learn(new)
            done = [b"".join(map(self.known.__getitem__, parts)) for parts in cut]
            for part in long:
                del self.known[part]
            for (i, _), ids in zip(group, done):
                if i != current:
                    yield np.frombuffer(b"".join(made), np.int32)
                    made, current = [], i
                made.append(ids)
        if texts:
            yield np.frombuffer(b"".join(made), np.int32)


def _groups(parts: Iterator[tuple[int, str]]) -> Iterator[list[tuple[int, str]]]:
    group, chars = [], 0
    for i, part in parts:
        group.append((i, part))
        chars += len(part)
        if chars >= CHUNK_CHARS:
            yield group
            group, chars = [], 0
    if group:
        yield group


def spans(text: bytes, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and next-to-last character of every token, from the bytes it holds."""
    ends = np.cumsum(sizes[ids])
    if not len(ids):
        return ends.astype(np.int32), ends.astype(np.int32)
    leads = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    char = np.cumsum(leads, dtype=np.int32) - 1
    return char[ends - sizes[ids]], char[ends - 1] + 1


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()))


def packed_tokenizer(spark: SparkSession, path: str, pattern: str | None):
    """A tokenizer's JSON, sent to the executors once; of a rank file if `pattern` is given."""
    if pattern is None:
        with open(path, encoding="utf-8") as file:
            text = file.read()
    else:
        text = tokenizer(read_ranks(path), pattern).to_str()
    return shipped(spark, text.encode(), os.path.basename(path))


def encoder(packed, offsets: bool):
    """Arrow function: texts to `ENCODED`; without `offsets`, starts and ends are null."""

    @F.arrow_udf(ENCODED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids_of = Encoder(packed.value)
        sizes = np.array([len(b) for b in bytes_of_ids(packed.value)], np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            ids = list(ids_of(texts))
            lists = [_lists(ids)]
            for side in zip(*(spans(t.encode(), i, sizes) for t, i in zip(texts, ids))) if offsets else ():
                lists.append(_lists(list(side)))
            empty = pa.nulls(len(ids), lists[0].type)
            yield pa.StructArray.from_arrays((lists + [empty, empty])[:3], fields=_FIELDS)

    return run


_FIELDS = [pa.field(n, pa.list_(pa.int32())) for n in ("ids", "starts", "ends")]


def decoder(packed):
    """Arrow function: ids to the bytes they stand for."""

    @F.arrow_udf(T.BinaryType())
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = bytes_of_ids(packed.value)
        for batch in batches:
            out = [None if ids is None else b"".join(map(table.__getitem__, ids)) for ids in batch.to_pylist()]
            yield pa.array(out, pa.binary())

    return run


def encode(
    docs: DataFrame, path: str, pattern: str | None, text_col: str = "text", offsets: bool = True
) -> DataFrame:
    """Every row with `ids`, and with `starts` and `ends`, the characters of each token.

    `path` is a rank file if `pattern` is given, else a tokenizer's JSON. Special tokens
    are never made; their strings are ordinary text. A null or empty text gives no ids. A
    column of `docs` with a new column's name is replaced; all other rows and columns,
    repeated ones too, stay as they are, and an empty table stays empty. A text of any
    length is encoded whole, `CHUNK_CHARS` characters at a time.
    """
    encoded = docs.withColumn("ids", encoder(packed_tokenizer(docs.sparkSession, path, pattern), offsets)(F.col(text_col)))
    fields = {"ids": F.col("ids.ids")}
    if offsets:
        fields |= {"starts": F.col("ids.starts"), "ends": F.col("ids.ends")}
    return encoded.withColumns(fields)


def decode(rows: DataFrame, path: str, pattern: str | None, ids_col: str = "ids") -> DataFrame:
    """Every row with `decoded`, the bytes of its ids; null ids give null, no ids no bytes.

    An id outside the vocabulary is an error. Read as UTF-8, the bytes of whole documents
    are their texts; a part of the ids may begin or end within a character.
    """
    return rows.withColumn("decoded", decoder(packed_tokenizer(rows.sparkSession, path, pattern))(F.col(ids_col)))


def decoded_text(binary):
    """Decoded bytes as text; a character cut at either end becomes U+FFFD."""
    return F.call_function("make_valid_utf8", (F.col(binary) if isinstance(binary, str) else binary).cast("string"))


_LAST: dict[bytes, Encoder] = {}  # of this process, by its tokenizer's digest


def last_encoder(content: bytes) -> Encoder:
    """An encoder that this process keeps for its next task, with the parts it remembers."""
    key = hashlib.sha256(content).digest()
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = Encoder(content)
    return _LAST[key]


def id_arrays(packed, end_id: int) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """What turns a column of texts into ids, `end_id` behind those of each text."""

    def run(texts: pa.Array) -> Iterator[np.ndarray]:
        for ids in last_encoder(packed.value)([t or "" for t in texts.to_pylist()]):
            yield np.append(ids, np.int32(end_id))

    return run


@F.arrow_udf(T.BinaryType())
def id_bytes(ids: pa.Array) -> pa.Array:
    """Ids as little-endian unsigned 32-bit integers."""
    out = [None if not i.is_valid else i.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes() for i in ids]
    return pa.array(out, pa.binary())
