import random

import numpy as np

from provenant.llm import minhash
from provenant.llm.minhash import near_duplicates, op7_minhash, shared_counts
from provenant.llm.shingles import WORD, lowered


def brute(rows, size=2):
    sets = []
    for _, text in rows:
        w = WORD.findall(lowered(text or ""))
        sets.append({tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set())
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = find(rows[i][0]), find(rows[j][0])
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for (i, _), s in zip(rows, sets, strict=True)}


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = str(rng.randrange(10**6))
    return " ".join(words)


def sample(seed, n_bases, copies, most):
    rng, rows = random.Random(seed), []
    for _ in range(n_bases):
        base = [str(rng.randrange(5000)) for _ in range(rng.choice([3, 12, 60, 200]))]
        rows += [edited(rng, base, rng.randrange(1 + max(1, len(base) * most // 100))) for _ in range(rng.randrange(copies))]
    rows += ["", None, " \n", "One", "one", "ONE two", "one TWO", "É a", "é a"]
    rng.shuffle(rows)
    return list(enumerate(rows, 10))


def test_equals_brute_force(spark):
    rows = sample(4, 40, 12, 14)
    out = near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == brute(rows)


def test_large_group_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "PIVOTS", 4)
    rng = random.Random(8)
    base = [str(rng.randrange(5000)) for _ in range(80)]
    rows = [(i, edited(rng, base, rng.randrange(14))) for i in range(150)]
    out = near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == brute(rows)


def test_large_group_of_many_sizes(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "PIVOTS", 4)
    rng = random.Random(9)
    base = [str(rng.randrange(5000)) for _ in range(220)]
    rows = [(i, edited(rng, base[: round(40 * 1.12 ** (i % 16))], rng.randrange(9))) for i in range(240)]
    rows += [(240 + i, " ".join(base[: 51 + i * 64 // 50])) for i in range(14)]  # sizes at the edge of a link: 50 and 62.5
    out = near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), shingle_words=2).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out} == want and len({c for _, c, _ in want.values()}) > 1


def test_rows(spark):
    rows = [(5, "a b c", "x"), (5, "a b c", "y"), (None, "a b c", None), (9, "a b c", "z"), (7, None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    out = sorted(tuple(map(str, r)) for r in near_duplicates(spark, docs, shingle_words=2).collect())
    assert out == sorted([("5", "2", "5", "True")] * 2 + [("None", "2", "None", "True"), ("9", "2", "5", "False"), ("7", "0", "7", "True")])
    assert near_duplicates(spark, docs.limit(0), shingle_words=2).count() == 0


def test_shared_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 20000, n).astype(np.uint64)) for n in (0, 1, 50, 9000, 9000)]
    got = shared_counts(sets, sets[::-1])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[::-1]] for a in sets]


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in op7_minhash(spark, "/root/testdata/sf0.001").collect()} == brute(rows)


def test_operator_takes_five_words_by_default(spark):
    rng = random.Random(11)
    rows = []
    for i in range(0, 60, 3):
        w = [str(rng.randrange(10**6)) for _ in range(80)]
        near, far = list(w), list(w)
        near[3] = "x"
        for k in (10, 30, 50, 70):
            far[k] = "y"
        rows += [(i, " ".join(w)), (i + 1, " ".join(near)), (i + 2, " ".join(far))]
    want, got = brute(rows, 5), {r.doc_id: r.component_id for r in near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: want[i][1] for i, _ in rows} and got[1] == 0 and got[2] == 2
