import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from provenant.llm import oracles, variants
from provenant.llm.shingles import LOWER
from provenant.llm.variants import changed, hashes, letters, neighbours, op13_variants
from provenant.llm.variants import variants as grouped


def near(a, b):
    """Whether one edit separates two strings."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def vocabulary(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", (text or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            at = h % len(run)
            n[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute(docs):
    n, out = vocabulary(docs), set()
    nearby = {w: [v for v in n if near(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in nearby.items() if v}
    form = {w: v for w, v in best.items() if n[v] >= 10 * n[w]}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, n[w], len(nearby[w]), form.get(w), n.get(form.get(w)), root))
    return out


def rows(frame):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in frame.collect()}


def edit(rng, word):
    i, c = rng.randrange(len(word)), rng.choice("abcéß÷")
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]])


def sample(seed):
    rng, texts = random.Random(seed), []
    bases = ["".join(rng.choices("abcdeéßÀ", k=rng.randrange(7, 12))) for _ in range(25)]
    for i in range(120):
        words = [b.upper() if rng.random() < 0.1 else b for b in rng.choices(bases, weights=range(1, 26), k=40)]
        words += [edit(rng, edit(rng, b) if rng.random() < 0.3 else b) for b in rng.choices(bases, k=6)]
        texts.append((i, rng.choice([" ", "\n", ", ", "3"]).join(words)))
    return texts


def test_equals_brute_force(spark):
    docs = [*sample(3), (900, None), (901, ""), (None, "nullids nullids nullidt nullidt"), (902, "short runs a b c" * 9), (903, "aaaaaaa aaaaaaaa " * 20)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n int").repartition(3)
    got, want = rows(grouped(spark, frame)), brute(docs)
    assert got == want and any(r[3] for r in want)


def test_chains_ties_and_repeated_rows(spark):
    """baaaaaa -> aaaaaaa -> aaaaaaab -> aaaaaaabb, and equally common neighbours: the smallest is the form."""
    counts = {"baaaaaa": 2, "aaaaaaa": 20, "aaaaaaab": 200, "aaaaaaabb": 2000, "xxxxxxx": 2, "xxxxxxb": 30, "xxxxxxa": 30, "yyyyyyy": 3, "yyyyyyz": 29}
    frame = spark.createDataFrame([(7, w) for w, n in counts.items() for _ in range(n)], "doc_id long, text string")
    got = {r.word: r for r in grouped(spark, frame, deleted_of=0).collect()}
    assert {w: r.n for w, r in got.items()} == counts
    assert [got[w].root for w in ("baaaaaa", "aaaaaaa", "aaaaaaab", "aaaaaaabb")] == ["aaaaaaabb"] * 4
    assert got["xxxxxxx"].form == "xxxxxxa" and got["yyyyyyy"].form is None and got["yyyyyyy"].n_near == 1


@pytest.mark.parametrize("word", ["abcabca", "aaaaaaa", "aabbccé", "é" * 9])
def test_all_distinct_changes_once(word):
    alphabet = np.array([ord(c) for c in "abcé"], np.uint8)
    made = []
    for change, places, h, distinct in neighbours(letters([word]), alphabet):
        at = np.flatnonzero(distinct.ravel())
        row, place, letter = np.unravel_index(at, h.shape)
        texts = changed(letters([word]), change, row, places[place], alphabet[letter])
        assert [int(hashes(letters([t]))[0]) for t in texts] == h.ravel()[at].tolist()
        made += texts
    cuts = range(len(word) + 1)
    want = {word[:i] + word[i + 1 :] for i in cuts[:-1]} | {word[:i] + c + word[i + 1 :] for i in cuts[:-1] for c in "abcé"} | {word[:i] + c + word[i:] for i in cuts for c in "abcé"}
    assert sorted(made) == sorted(want - {word})


def test_a_full_filter_loses_nothing():
    words = ["abcdefg", "abcdefh", "abcdef" + "g" * 40, "abcdef" + "g" * 41]
    got = {(words[i], t) for at, near_words in variants.candidates(words, np.array(sorted({*map(ord, "".join(words))}), np.uint8), np.full(1 << 15, 255, np.uint8)) for i, t in zip(at, near_words, strict=True)}
    assert {("abcdefg", "abcdefh"), ("abcdefh", "abcdefg"), (words[2], words[3]), (words[3], words[2])} <= got and len(got) > 1000


def test_very_long_words_and_texts(spark):
    long = "ab" * 20_000
    docs = [(1, f"{long} {long} {long}x {long}x"), (2, "filler " * 300_000)]
    got = {len(r.word): (r.n, r.n_near) for r in grouped(spark, spark.createDataFrame(docs, "doc_id long, text string"), deleted_of=0, shortest=6).collect()}
    assert got == {40_000: (2, 1), 40_001: (2, 1), 6: (300_000, 0)}


def test_empty_tables(spark):
    for docs in ([], [(1, None), (2, ""), (3, "once upon a time")]):
        assert grouped(spark, spark.createDataFrame(docs, "doc_id long, text string")).count() == 0


def test_query_equals_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = rows(op13_variants(spark, sf))
    assert {(r[0], r[1]) for r in got} == set(vocabulary(docs).items())
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
        assert got == {(r[0], r[3], r[4], r[1], r[5], r[2]) for r in duck.execute(oracles.VARIANTS).fetchall()}
