"""Token ids in length-delimited binary records, with an index for reads in any order.

A record is: length (8 bytes, little-endian), masked checksum of the length (4), data,
masked checksum of the data (4). The checksum is CRC-32C; masked means turned right by 15
bits plus a constant, so that a checksum of data that holds checksums stays sound. Readers
of the common framing of serialized training examples read these files.

The data of a record is: document id (8, signed; 0 for a null one), bytes per id (1, its
highest bit set for a null document id), then the ids, 2 or 4 bytes each as the vocabulary
needs.

Each task of a range shuffle writes one file and returns one index line per record. The
index is a Parquet table that only holds lines of committed tasks: a file of a task that
was lost and run again has another name and is never read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import Scratch, shuffle_parts

# Fixed values of the format.
CASTAGNOLI = 0x82F63B78
MASK_DELTA = 0xA282EAD8
NO_ID = 0x80  # set in the byte of the width where the document has no id
LANE = 64  # bytes of each of the lanes whose checksums advance together
INDEX = "doc_id bigint, part int, file string, at bigint, length bigint, n_tokens bigint, before bigint"
RECORDS = "doc_id bigint, part int, before bigint, n_tokens bigint, ids_crc32 bigint, ids array<bigint>"


def _tables() -> tuple[np.ndarray, list[list[int]]]:
    """The step of one byte, and what `LANE` zero bytes make of each byte of a checksum."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(CASTAGNOLI), step >> 1).astype(np.uint32)
    far = np.array([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)], np.uint32)
    for _ in range(LANE):
        far = step[far & 255] ^ (far >> np.uint32(8))
    return step, far.tolist()


_STEP, _FAR = _tables()


def crc32c_each(datas: list[bytes]) -> list[int]:
    """CRC-32C of each string of bytes.

    Zeros in front of the data change nothing, so each is filled up to lanes of `LANE`
    bytes; the lanes of all of them advance side by side and are then strung together.
    The start value flips the first four bytes.
    """
    pads = [-len(d) % LANE if len(d) >= 4 else 0 for d in datas]
    buffer = np.zeros(sum(p + len(d) for p, d in zip(pads, datas) if len(d) >= 4), np.uint8)
    at = 0
    for pad, data in zip(pads, datas):
        if len(data) >= 4:
            at += pad
            buffer[at : at + len(data)] = np.frombuffer(data, np.uint8)
            buffer[at : at + 4] ^= 255
            at += len(data)
    lanes = np.ascontiguousarray(buffer.reshape(-1, LANE).T)
    crcs = np.zeros(lanes.shape[1], np.uint32)
    for column in lanes:
        crcs = _STEP[(crcs ^ column) & 255] ^ (crcs >> np.uint32(8))
    parts, place, out = crcs.tolist(), 0, []
    f0, f1, f2, f3 = _FAR
    for pad, data in zip(pads, datas):
        if len(data) < 4:
            crc = 0xFFFFFFFF
            for b in data:
                crc = int(_STEP[(crc ^ b) & 255]) ^ (crc >> 8)
        else:
            n, crc = (pad + len(data)) // LANE, 0
            for lane in parts[place : place + n]:
                crc = f0[crc & 255] ^ f1[crc >> 8 & 255] ^ f2[crc >> 16 & 255] ^ f3[crc >> 24] ^ lane
            place += n
        out.append(crc ^ 0xFFFFFFFF)
    return out


def masked_each(datas: list[bytes]) -> list[bytes]:
    turned = (((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF for crc in crc32c_each(datas))
    return [struct.pack("<I", crc) for crc in turned]


def frames(datas: list[bytes]) -> list[bytes]:
    """The record of each string of bytes."""
    lengths = [struct.pack("<Q", len(d)) for d in datas]
    sums = masked_each([*lengths, *datas])
    return [b"".join(x) for x in zip(lengths, sums, datas, sums[len(datas) :])]


def unframed(records: list[bytes]) -> list[bytes]:
    """The data of each record; raises if a length or a checksum is not right."""
    datas = [r[12:-4] for r in records]
    sums = masked_each([*(r[:8] for r in records), *datas])
    for record, data, head, tail in zip(records, datas, sums, sums[len(datas) :]):
        if len(record) < 16 or record[:8] != struct.pack("<Q", len(data)) or record[8:12] != head:
            raise ValueError("damaged record length")
        if record[-4:] != tail:
            raise ValueError("damaged record")
    return datas


def packed(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack("<qB", doc_id or 0, width | NO_ID if doc_id is None else width) + ids.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, width = struct.unpack_from("<qB", data)
    return (None if width & NO_ID else doc_id), np.frombuffer(data, f"<u{width & ~NO_ID}", offset=9).astype("<u4")


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and its path there; a plain path is a local one."""
    return pafs.FileSystem.from_uri(uri)


def write(rows: DataFrame, folder: str, ids_of: Callable[[pa.Array], Iterator[np.ndarray]], width: int) -> DataFrame:
    """Write (doc_id, text) as records in ascending id order; gives the index, one row per record.

    `ids_of` turns a column of texts into ids. `folder` must be one that all executors
    reach. Null ids come first; equal ids are ordered by their texts' hashes, and rows
    alike in both are alike. No rows give no record. Each index row: doc_id, part (the
    file's number), file, at and length (of its record there), n_tokens, before (ids
    before it in the file).
    """
    spark = rows.sparkSession
    files, index = f"{folder}/records", f"{folder}/index"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(files)
        fs.create_dir(base, recursive=True)
        context = TaskContext.get()
        part, name = context.partitionId(), f"part-{context.partitionId():06d}-{uuid4().hex}.rec"
        out, at, before = None, 0, 0
        try:
            for batch in batches:
                lines = []
                names, each = batch.column(0).to_pylist(), list(ids_of(batch.column(1)))
                made = frames([packed(doc_id, ids, width) for doc_id, ids in zip(names, each)])
                for doc_id, ids, record in zip(names, each, made):
                    out = out or fs.open_output_stream(f"{base}/{name}")
                    out.write(record)
                    lines.append((doc_id, part, name, at, len(record), len(ids), before))
                    at, before = at + len(record), before + len(ids)
                columns = list(zip(*lines)) or [()] * 7
                kinds = [pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["doc_id", "part", "file", "at", "length", "n_tokens", "before"],
                )
        finally:
            if out is not None:
                out.close()

    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.select("doc_id", "text").repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
    ordered.mapInArrow(run, INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def read(index: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """The records that the rows of an index point to, in any order and any choice.

    Each task opens a file once for neighbouring rows of it and reads just the records
    asked for; lengths and checksums are checked, and the ids' own document id must be
    the index row's.
    """
    files = f"{folder}/records"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(files)
        name, source = None, None
        for batch in batches:
            lines = []
            rows, records = batch.to_pylist(), []
            for row in rows:
                if row["file"] != name:
                    if source is not None:
                        source.close()
                    name = row["file"]
                    source = fs.open_input_file(f"{base}/{name}")
                records.append(source.read_at(row["length"], row["at"]))
            for row, (doc_id, ids) in zip(rows, map(unpacked, unframed(records))):
                if doc_id != row["doc_id"]:
                    raise ValueError(f"{row['file']} has document {doc_id} where its index has {row['doc_id']}")
                lines.append((doc_id, row["part"], row["before"], len(ids), zlib.crc32(ids.tobytes()), ids.astype(np.int64) if with_ids else None))
            columns = list(zip(*lines)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "part", "before", "n_tokens", "ids_crc32", "ids"],
            )

    return index.mapInArrow(run, RECORDS)


def starts(index: DataFrame) -> DataFrame:
    """(part, start): the ids in all files before each; one row per file."""
    sizes = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))


def remove_orphans(spark: SparkSession, index: DataFrame, folder: str) -> int:
    """Delete record files that no index row names: those of tasks that were lost."""
    named = {r["file"] for r in index.select("file").distinct().collect()}  # one per task
    fs, base = open_folder(f"{folder}/records")
    found = fs.get_file_info(pafs.FileSelector(base, allow_not_found=True))
    orphans = [f.path for f in found if f.base_name not in named]
    for path in orphans:
        fs.delete_file(path)
    return len(orphans)
