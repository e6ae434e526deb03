import hashlib
import random

import numpy as np
import pytest

from provenant.llm import suffix_dedup
from provenant.llm.suffix_dedup import Shard, merge, op2_suffix_dedup, remove_repeats


def brute(rows):
    big = 1 << 63
    first, out = {}, []
    data = [((i if i is not None else big), (t or "").encode()) for i, t in rows]
    for i, b in data:
        for k in range(len(b) - 49):
            s = b[k : k + 50]
            first[s] = min(first.get(s, big), i)
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((str(None if i == big else i), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_merge_gives_repeated_intervals_and_common_prefixes():
    rng = random.Random(3)
    for depth in (1, 3, 8):
        strings = [bytes(rng.choices(b"ab\x00", k=rng.randrange(1, 12))) for _ in range(12)]
        shards = [Shard(strings[:5]), Shard(strings[5:6]), Shard(strings[6:])]
        suffixes = [strings[base + i][o:] for base, s in zip((0, 5, 6), shards, strict=True) for i, o in zip(s.string, s.offset, strict=True)]
        for s, base in zip(shards, (0, 5, 6), strict=True):  # each shard's own order
            own = [strings[base + i][o:] for i, o in zip(s.string, s.offset, strict=True)]
            assert own == sorted(own)
        rows, interval, prefix = merge(shards, depth)
        groups = {}
        for i, x in enumerate(suffixes):
            if len(x) >= depth:
                groups.setdefault(x[:depth], set()).add(i)
        found = {}
        for r, k in zip(rows, interval, strict=True):
            found.setdefault(k, set()).add(r)
        assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)
        ordered = [suffixes[next(iter(found[k]))][:depth] for k in sorted(found)]
        assert ordered == sorted(ordered)
        for i, x in enumerate(suffixes):
            most = max(next((j for j in range(depth) if x[j : j + 1] != y[j : j + 1] or not x[j : j + 1]), depth) for k, y in enumerate(suffixes) if k != i)
            assert prefix[i] == most


def test_rounds_of_several_symbols_give_the_same_intervals():
    rng = random.Random(8)
    for alphabet, count in ((b"ab\x00", 40), (bytes(range(256)), 200)):
        pool = [bytes(rng.choices(alphabet, k=70)) for _ in range(6)]
        strings = [p[(a := rng.randrange(30)) : a + rng.randrange(60)] for p in rng.choices(pool, k=count)]
        shards = [Shard(strings[:9]), Shard(strings[9:])]
        for depth in (1, 7, 50):
            rows, interval, _ = merge(shards, depth)
            for stride in (2, 3, 5):
                found = merge(shards, depth, stride)
                assert np.array_equal(found[0], rows) and np.array_equal(np.unique(found[1], return_inverse=True)[1], np.unique(interval, return_inverse=True)[1])


@pytest.mark.parametrize(("block_bytes", "seed"), [(700, 1), (1 << 20, 2)])
def test_equals_brute_force(spark, monkeypatch, block_bytes, seed):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block_bytes)
    rng = random.Random(seed)
    pool = ["".join(rng.choices("abcdé ", k=300)) for _ in range(6)] + ["ab" * 100, "x" * 150]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(5)):
            p, a = rng.choice(pool), rng.randrange(100)
            parts.append(p[a : a + rng.randrange(200)] if rng.random() < 0.7 else "".join(rng.choices("efgh", k=30)))
        rows.append((i, "".join(parts)))
    rows += [(7, pool[0]), (7, pool[0]), (None, pool[1]), (None, pool[1]), (90, None), (91, ""), (92, "short"), (93, "y" * 49), (94, "y" * 50), (95, "y" * 51)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(remove_repeats(spark, docs)) == brute(rows)


def test_empty_table_and_kept_bytes(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, payload string")
    assert remove_repeats(spark, docs).count() == 0
    docs = spark.createDataFrame([(1, "q" * 60), (2, "z" + "q" * 60)], "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept_bytes) for r in remove_repeats(spark, docs, with_text=True).collect()} == {1: b"q" * 60, 2: b"z"}


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert result(op2_suffix_dedup(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_largest_id_is_not_null(spark):
    rows = [(2**63 - 1, "z" * 20 + "a b" * 30), (None, "a b" * 30), (5, "a b" * 30)]
    got = {r.doc_id: r.n_removed for r in remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {2**63 - 1: 90, None: 90, 5: 0}
