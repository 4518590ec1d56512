"""The registered queries at a small size, against plain libraries where SQL has no answer."""

import hashlib
import os
import zlib

import numpy as np
import pytest
import tiktoken

from barloom.llm import bpe, langid, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    enc = tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=bpe.read_ranks(queries.RANKS), special_tokens={})
    return {k: enc.encode_ordinary(t or "") for k, t in texts.items()}


def test_op1(spark, texts, ids):
    got = {tuple(r) for r in queries.QUERIES["op1_bpe"](spark, SF_DIR).collect()}
    assert got == {
        (k, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256((texts[k] or "").encode()).hexdigest())
        for k, i in ids.items()
    }


def test_op3(spark, texts):
    rows = queries.QUERIES["op3_langid"](spark, SF_DIR).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows) and len(rows) == len(texts)
    held = [r for r in rows if r.held_out]
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def test_op9(spark, ids):
    start = 0
    got = {r.doc_id: r for r in queries.QUERIES["op9_records"](spark, SF_DIR).collect()}
    for k in sorted(ids):
        every = np.array([*ids[k], 2], "<u4")
        assert tuple(got[k]) == (k, start, len(every), zlib.crc32(every.tobytes()))
        start += len(every)


def test_op10(spark, texts):
    got = queries.QUERIES["op10_interleave"](spark, SF_DIR).collect()
    assert len(got) == len(texts) and {r.law for r in got} == {"rows"} and {r.shard for r in got} <= set(range(40))


def test_sql_belongs_to_queries():
    assert set(queries.oracle_sql()) <= set(queries.queries())
