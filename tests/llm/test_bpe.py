import hashlib

import fixtures
import public_tokenizers
import pytest
import tiktoken

from barloom.llm import bpe, queries

RANKS = bpe.read_ranks(queries.RANKS)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_ids_offsets_and_bytes(docs, library):
    encoded = bpe.encode(docs, queries.RANKS, queries.PATTERN)
    got = bpe.decode(encoded, queries.RANKS, queries.PATTERN).withColumn("back", bpe.decoded_text("decoded")).collect()
    assert len(got) == len(fixtures.rows())
    for r in got:
        text = r.text or ""
        assert r.ids == library.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode() and r.back == text
        for i, s, e in zip(r.ids, r.starts, r.ends):
            piece = library.decode_single_token_bytes(i)
            assert piece in text[s:e].encode()
        # Tokens cover all characters, neighbours share one only if it is split.
        assert not text or (r.starts[0] == 0 and r.ends[-1] == len(text))
        assert all(b in (a, a - 1) for a, b in zip(r.ends, r.starts[1:]))
        assert r.kept == ("k" if r.m == "m" else None)


def test_split_characters(spark):
    ids = bpe.encode(spark.createDataFrame([("漢😀",)], "text string"), queries.RANKS, queries.PATTERN)
    half = ids.selectExpr("slice(ids, 1, 1) ids")
    row = bpe.decode(half, queries.RANKS, queries.PATTERN).select(bpe.decoded_text("decoded").alias("t")).first()
    assert "\ufffd" in row.t


def test_long_texts_are_cut_where_no_match_crosses(library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 50)
    monkeypatch.setattr(bpe.Encoder, "LIMIT", 5)
    ids_of = bpe.Encoder(bpe.tokenizer(RANKS, queries.PATTERN).to_str().encode())
    texts = ["", "it's 12 o'clock\n\n  and we   're\tlate!? " * 40, "x" * 400, "a  b \x1c c  \n d" * 30, "<|endoftext|> " * 20]
    texts += ["\n\n The end.\n  \n", "don't, can't!! a.b ...x \u0301e e\u0301 ª º ß 12%% $5 *", "end ", " ", "\n", "a\u00a0b c"]
    made = [list(map(int, ids)) for ids in ids_of(texts)]
    assert made == [library.encode_ordinary(t) for t in texts]
    assert all("".join(bpe.pieces(t, 50)) == t for t in texts)


def test_json_tokenizer_gives_the_same_ids(docs, library):
    for r in bpe.encode(docs, queries.TOKENIZER, None, offsets=False).collect():
        assert r.ids == library.encode_ordinary(r.text or "")


def test_digests(spark, docs, library):
    row = docs.where("doc_id = 2").select(bpe.id_bytes(bpe.encoder(bpe.packed_tokenizer(spark, queries.RANKS, queries.PATTERN), False)("text")["ids"]).alias("b")).first()
    ids = library.encode_ordinary(dict((r[0], r[1]) for r in fixtures.rows())[2])
    assert hashlib.sha256(bytes(row.b)).hexdigest() == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()


def test_empty_table(no_docs):
    made = bpe.decode(bpe.encode(no_docs, queries.RANKS, queries.PATTERN), queries.RANKS, queries.PATTERN)
    assert made.collect() == [] and {"ids", "starts", "ends", "decoded"} <= set(made.columns)


def test_unknown_rank_file_is_refused():
    with pytest.raises(ValueError):
        bpe.merge_of(b"abcd", {b"a": 0, b"b": 1, b"c": 2, b"d": 3, b"abcd": 4})
