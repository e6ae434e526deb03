import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from provenant.llm import importance, oracles
from provenant.llm.importance import Counter, counted, op11_importance, resampled
from provenant.llm.shingles import LOWER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, buckets=10_000):
    words = WORD.findall((text or "").translate(LOWER))
    return [zlib.crc32(f.encode()) % buckets for f in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]


def brute(docs, target, percent=25, min_words=20):
    """{(doc_id, text): (n_features, weight, score, rank)} of rows that differ."""
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for _, text in docs:
        np.add.at(s, features(text), 1)
    for text in target:
        np.add.at(t, features(text), 1)
    gain = [math.floor(1000 * math.log((a + 1) * (s.sum() + 10_000) / ((b + 1) * (t.sum() + 10_000)))) for a, b in zip(t.tolist(), s.tolist(), strict=True)]
    out, able = {}, []
    for i, text in docs:
        f = features(text)
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i, text] = [len(f), weight, score, None]
        if len(WORD.findall((text or "").translate(LOWER))) >= min_words:
            able.append((-score, i is None, i or 0, i, text))
    for rank, (*_, i, text) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        out[i, text][3] = rank
    return {k: tuple(v) for k, v in out.items()}


def sample(seed, n):
    rng = random.Random(seed)
    parts = ["the", "The", "tree", "Baum", "été", "ÉTÉ", "x1", "7", ".", "-", "\n", "\x00", "日本", "'", "a_b", "q"]
    return [(i * 3, " ".join(rng.choices(parts, k=rng.choice([0, 3, 22, 60, 200])))) for i in range(n)]


def test_equals_brute_force(spark):
    docs = [*sample(1, 150), (1000, None), (1001, ""), (1002, "A" * 30), (None, "one " * 30), (2**63 - 1, "two words " * 15)]
    target = [None, "", "the tree. The Baum", "日本 été x1 " * 20]
    frame = spark.createDataFrame([(i, t, "x", 5) for i, t in docs], "doc_id long, text string, rank string, score int").repartition(3)
    out = resampled(spark, frame, spark.createDataFrame([(t,) for t in target], "text string"))
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = sorted(((i, *v) for (i, _), v in brute(docs, target).items()), key=str)
    assert sorted((tuple(r) for r in out.collect()), key=str) == want and any(r[4] for r in want)


def test_ties_and_repeated_rows(spark):
    rows = [(5, "same words here " * 9)] * 6 + [(None, "same words here " * 9)] * 2 + [(5, "others " * 25)]
    out = resampled(spark, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("others",)], "text string"), percent=50).collect()
    assert len(out) == 9 and sorted(r.rank for r in out if r.rank) == [1, 2, 3, 4]
    drawn = sorted((r for r in out if r.rank), key=lambda r: r.rank)
    assert [r.score for r in drawn] == sorted((r.score for r in out), reverse=True)[:4]


@pytest.mark.parametrize("target", [[], ["a b"]])
def test_empty_tables(spark, target):
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    assert resampled(spark, spark.createDataFrame([], "doc_id long, text string"), wanted).count() == 0
    docs = [(1, "a b c " * 10), (2, "d e " * 20)]
    got = {(r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in resampled(spark, spark.createDataFrame(docs, "doc_id long, text string"), wanted, percent=100).collect()}
    assert got == {(i, *v) for (i, _), v in brute(docs, target, 100).items()}


def test_texts_in_slices_and_pieces(monkeypatch):
    """Pieces and statements of a few characters: pairs that reach over a cut count once."""
    monkeypatch.setattr(importance, "SLICE_CHARS", 40)
    monkeypatch.setattr(importance, "PIECE_CHARS", 9)
    docs = [*sample(2, 60), (9001, "....." * 30), (9002, "é" * 100), (9003, None), (9004, "a" * 45 + ". b ...... c " + "d" * 30)]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array([t for _, t in docs])], ["doc_id", "text"])
    rows = [r for b in counted(iter([batch]), 10_000, 20) for r in b.to_pylist()]
    for (i, text), row in zip(docs, rows, strict=False):
        want = np.bincount(features(text), minlength=10_000)
        assert row["doc_id"] == i and row["buckets"] == np.flatnonzero(want).tolist() and row["counts"] == want[want > 0].tolist()
        assert row["enough"] == (len(WORD.findall((text or "").translate(LOWER))) >= 20)
    every = np.bincount([b for _, t in docs for b in features(t)], minlength=10_000)
    assert rows[-1]["enough"] is None and rows[-1]["counts"] == every[every > 0].tolist() and len(rows) == len(docs) + 1


def test_a_very_long_text():
    text = "Some words, and 12 more of them: été! " * 160_000  # 6 MB
    total = Counter(10_000).long_text(text)
    assert (total == np.bincount(features(text), minlength=10_000)).all()


def test_query_equals_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in op11_importance(spark, sf).collect()), key=str)
    assert got == sorted(((i, *v) for (i, _), v in brute(docs, target).items()), key=str)
    with duckdb.connect() as duck:
        for name in ("documents", "benchmark"):
            duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
        assert got == sorted(duck.execute(oracles.IMPORTANCE).fetchall(), key=str)
