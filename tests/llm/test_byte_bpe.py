import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from provenant.llm import byte_bpe
from provenant.llm.byte_bpe import Vocabulary, decode, encode, library, splitter

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def texts():
    rng = random.Random(2)
    alphabet = ["a", "the", " ", "  ", "\n", "'s", "'", "!", "1", "23", "é", "ß", "日", "՘", "\U00010940", "\U0001f600", "\x1c", "\xa0", "\t", "<|endoftext|>"]
    return [None, "", " ", "\n\n", "Don't  stop!\n", "a" * 3000, "<|endoftext|>"] + ["".join(rng.choices(alphabet, k=rng.randrange(50))) for _ in range(500)]


def test_splits_as_the_library():
    enc, split = library(RANKS, PATTERN), splitter(PATTERN)
    for text in texts():
        if text:
            assert [i for w in split(text) for i in enc._encode_single_piece(w.encode())] == enc.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_encode_and_decode(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", block_bytes)
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(5, "twice", "y"), (5, "twice", "y"), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    enc = library(RANKS, PATTERN)
    got = sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in decode(encode(spark, docs, RANKS, PATTERN), RANKS).collect())
    want = []
    for i, t, _ in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((str(i), len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()))
    assert got == sorted(want)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert decode(encode(spark, docs, RANKS, PATTERN), RANKS).count() == 0


def test_query_on_small_table(spark):
    out = {r.doc_id: r for r in byte_bpe.op5_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    enc = library(RANKS, PATTERN)
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = enc.encode_ordinary(r.text)
        assert out[r.doc_id].n_tokens == len(ids)
        assert out[r.doc_id].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_ids_and_nulls_apart(spark):
    rows = [(2**63 - 1, "last"), (None, "none"), (0, None)]
    got = {r.doc_id: bytes(r.decoded) for r in encode(spark, spark.createDataFrame(rows, "doc_id long, text string"), RANKS, PATTERN, with_decoded=True).collect()}
    assert got == {2**63 - 1: b"last", None: b"none", 0: b""}


def test_decoding_refuses_unknown_ids():
    import numpy as np

    words = Vocabulary(RANKS)
    assert words.decode(np.zeros(0, "<u4")) == b"" and words.decode(np.array(words.encode(b"hello world"), "<u4")) == b"hello world"
    with pytest.raises(ValueError):
        words.decode(np.array([4_000_000_000], "<u4"))
