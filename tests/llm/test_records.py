import random
import zlib
from types import SimpleNamespace

import fixtures
import numpy as np
import pyarrow as pa
import pytest

from barloom.llm import bpe, queries, records
from barloom.llm.common import Scratch


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = (crc >> 1) ^ (records.CASTAGNOLI if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def test_checksum():
    assert records.crc32c_each([b"123456789"]) == [0xE3069283]
    rng = np.random.default_rng(1)
    datas = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in (0, 1, 3, 4, 5, 63, 64, 127, 128, 129, 1000)]
    assert records.crc32c_each(datas) == list(map(plain_crc32c, datas))
    assert records.unframed(records.frames(datas)) == datas
    assert records.frames([]) == records.unframed([]) == []


def test_damage_is_found():
    record = bytearray(records.frames([b"some data" * 30])[0])
    for i in (0, 9, 40, len(record) - 1):
        broken = record.copy()
        broken[i] ^= 1
        with pytest.raises(ValueError):
            records.unframed([bytes(broken)])


@pytest.fixture(scope="module")
def written(spark, docs):
    folder = Scratch(spark, "records").root
    packed = bpe.packed_tokenizer(spark, queries.TOKENIZER, None)
    return records.write(docs, folder, bpe.id_arrays(packed, 2), width=2), folder, bpe.loaded(packed.value)


def test_round_trip_in_id_order(written):
    index, folder, tok = written
    texts = sorted(((r[0] is not None, r[0], r[1]) for r in fixtures.rows()), key=lambda r: (r[0], r[1] or 0))
    got = records.read(index, folder).join(records.starts(index), "part").collect()
    got.sort(key=lambda r: r.file_start + r.before)
    assert [r.doc_id for r in got] == [t[1] for t in texts]
    start = 0
    for r in got:
        assert r.file_start + r.before == start and r.n_tokens == len(r.ids) and r.ids[-1] == 2
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        start += r.n_tokens
    ids = {r.doc_id: r.ids for r in got if r.doc_id is not None}
    for doc_id, text, *_ in fixtures.rows():
        if doc_id is not None:
            assert ids[doc_id] == [*tok.encode(text or "", add_special_tokens=False).ids, 2]


def test_shuffled_reads_of_some_records(written):
    index, folder, _ = written
    some = index.where("doc_id % 3 = 0").orderBy("length")
    assert {r.doc_id for r in records.read(some, folder).collect()} == {r.doc_id for r in some.collect()}


def test_files_are_plain_frames(written):
    index, folder, _ = written
    fs, base = records.open_folder(f"{folder}/records")
    for r in index.groupBy("file").agg({"length": "sum", "*": "count"}).collect():
        data, n = fs.open_input_file(f"{base}/{r.file}").read(), 0
        assert len(data) == r["sum(length)"]
        while data:
            size = int.from_bytes(data[:8], "little") + 16
            records.unpacked(records.unframed([data[:size]])[0])
            data, n = data[size:], n + 1
        assert n == r["count(1)"]


def test_files_of_lost_tasks_are_removed(spark, written):
    index, folder, _ = written
    fs, base = records.open_folder(f"{folder}/records")
    with fs.open_output_stream(f"{base}/part-000000-lost.rec") as out:
        out.write(b"half a record")
    assert records.remove_orphans(spark, index, folder) == 1
    assert records.read(index, folder).count() == len(fixtures.rows())


def test_empty_table(spark, no_docs):
    folder = Scratch(spark, "records").root
    packed = bpe.packed_tokenizer(spark, queries.TOKENIZER, None)
    index = records.write(no_docs, folder, bpe.id_arrays(packed, 2), width=2)
    assert records.read(index, folder).collect() == []


@pytest.mark.parametrize("doc_id", [None, 0, -1, -(2**63), 2**63 - 1])
@pytest.mark.parametrize("width", [2, 4])
def test_every_id_comes_back(doc_id, width):
    ids = np.array([0, 2, 2**15], np.int64)
    got, back = records.unpacked(records.packed(doc_id, ids, width))
    assert got == doc_id and back.tolist() == ids.tolist()


def test_tasks_of_a_process_learn_a_part_once(monkeypatch):
    rng = random.Random(8)
    texts = [fixtures.document(rng) for _ in range(6)]
    learnt, learn = [], bpe.Encoder.learn
    monkeypatch.setattr(bpe.Encoder, "learn", lambda self, parts: (learnt.extend(parts), learn(self, parts)))
    with open(queries.TOKENIZER, "rb") as file:
        packed = SimpleNamespace(value=file.read() + b"\n")
    first, second = ([ids.tolist() for ids in bpe.id_arrays(packed, 2)(pa.array(texts))] for _ in range(2))
    assert first == second and learnt and len(learnt) == len(set(learnt))


def test_forgotten_parts_are_learnt_again(monkeypatch):
    monkeypatch.setattr(bpe.Encoder, "LIMIT", 40)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 200)
    rng = random.Random(9)
    texts = [fixtures.document(rng) + " " + "y" * 80 for _ in range(20)] * 2
    with open(queries.TOKENIZER, "rb") as file:
        encoder = bpe.Encoder(file.read())
    want = [encoder.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder(texts)] == want and encoder.before
