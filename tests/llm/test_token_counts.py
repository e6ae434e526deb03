import random

import public_tokenizers
import pytest
import sentencepiece

from provenant.llm.token_counts import Counts, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CASES = [
    "", " ", "  ", "a", " a", "  a b  ", "a\nb", "a\n b", "a \n\n  b\n", "\n", "\n\n a", "<s>x</s><unk>", "▁a", "a▁b",
    "\x00a", "é 日本語 text", "\t\ta\r\nb", "x" * 5000, "\U0001f600\U0001f600 ok", "1234567 8.9", " " * 70 + "z",
]


def test_equals_the_library():
    counts, library = Counts(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(5)
    alphabet = [" ", "  ", "\n", "a", "the", "tion", "▁", "\t", "é", "ß", ".", "7", "日", "\U0001f600", "<s>"]
    texts = CASES + ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(3000)]
    for text in texts:
        assert counts.count(text) == len(library.encode(text)), repr(text)


def test_a_long_text_in_segments():
    counts, library = Counts(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = ("Some words  and\nmore of them. " * 60_000)[:1_500_000]
    assert counts.count(text) == len(library.encode(text))


def test_remembered_table_is_bounded(monkeypatch):
    monkeypatch.setattr("provenant.llm.token_counts.REMEMBERED", 10)
    counts = Counts(MODEL)
    for i in range(100):
        counts.count(f"qzx{i}y wvq{i}")
    assert len(counts) <= len(counts.shortcut) + 11


@pytest.mark.parametrize("rows", [[], [(1, "a b", 9, "n"), (1, "a b", 9, "n"), (2, None, None, None), (None, "", 1, "m")]])
def test_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, lang string")
    out = token_counts(docs, MODEL)
    assert out.columns == ["doc_id", "text", "lang", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((tuple(r) for r in out.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()), key=str)
    assert got == sorted([(r[0], len(r[1] or ""), 2 if r[1] else 0, False) for r in rows], key=str)


def test_query_equals_the_library(spark):
    from provenant.llm.token_counts import op10_token_counts

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = op10_token_counts(spark, "/root/testdata/sf0.001").collect()
    want = {i: (len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 4096) for i, t in texts.items()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == want and len(got) == len(want)
