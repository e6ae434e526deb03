import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from provenant.llm.common import written
from provenant.llm.fingerprints import Signed, edited_fingerprints, fingerprints, folded, likeness, minima, near_classes, op12_fingerprints, with_next
from tests.llm.test_minhash import brute as brute_classes


def edited_texts(rows):
    """{(doc_id, text): (edited, next)}: the next text by ids, the smallest of a repeated one; null ids come last."""
    order, first = [], {}
    for i, text in sorted(((i is None, i or 0), (t or "").encode()) for i, t in rows):
        if i not in first:
            order.append(i)
            first[i] = text
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    out = {}
    for i, t in rows:
        text, following = t or "", first[after[i is None, i or 0]].decode()
        n = len(text)
        out[i, t] = (text[: n - n // 2] + following[: n // 2], following)
    return out


def print_of(text):
    p = Signed.of(pa.array([text], pa.large_string()), 5).prints()[0]
    return p, "" if p is None else p.tobytes().hex()


def brute(rows):
    out = []
    for i, t in rows:
        edited, following = edited_texts(rows)[i, t]
        own, own_hex = print_of(t or "")
        other, other_hex = print_of(edited)
        out.append((i, len(t or ""), hashlib.sha256(edited.encode()).hexdigest(), own_hex, other_hex, likeness(own, other), likeness(own, print_of(following)[0])))
    return sorted(out, key=str)


def columns(frame):
    prints = [frame[c] for c in ("print", "edited_print")] if "print" in frame.columns else []
    names = ["doc_id", "n_chars", "edited_sha256", *(["print", "edited_print"] if prints else ["fingerprint", "edited_fingerprint"]), "near_edited", "near_next"]
    return sorted((tuple(bytes(x).hex() if isinstance(x, (bytes, bytearray)) else x for x in r) for r in frame.select(*names).collect()), key=str)


def sample(seed, n):
    rng = random.Random(seed)
    texts = ["", " \n", "One", "one", "é" * 7, "日本語 " * 9, None, "a b c d e f g h"]
    texts += [" ".join(rng.choices("abcdefgh", k=rng.randrange(80))) for _ in range(n)]
    ids = rng.sample(range(-50, 9000), len(texts))
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("part_bytes", [60, 900, 1 << 20])
def test_equals_brute_force(spark, part_bytes):
    rows = sample(4, 50)
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fingerprint string, part int").repartition(3)
    assert columns(edited_fingerprints(spark, frame, part_bytes=part_bytes)) == brute(rows)


@pytest.mark.parametrize("part_bytes", [100, 1 << 20])
def test_null_and_repeated_ids(spark, part_bytes):
    """A third of the rows without id, a third with one id: their parts are dealt in pieces."""
    rng = random.Random(6)
    text = lambda: " ".join(rng.choices("abcdefgh", k=rng.randrange(30)))
    rows = [(None, text()) for _ in range(30)] + [(7, text()) for _ in range(30)] + [(i, text()) for i in (5, 6, 8, 9, 2**63 - 1, -(2**63))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert columns(edited_fingerprints(spark, frame, part_bytes=part_bytes)) == brute(rows)
    counted = with_next(spark, frame, lambda ids, texts, after: pa.table({"n": pa.array([len(texts)], pa.int64())}), "n long", part_bytes).collect()
    assert sum(r.n for r in counted) == 66 and (part_bytes > 100 or max(r.n for r in counted) <= 12)


@pytest.mark.parametrize("rows", [[], [(1, "one two three")], [(None, "alone")], [(None, None), (None, "z"), (None, "b c")]])
def test_small_tables(spark, rows):
    assert columns(edited_fingerprints(spark, spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_likeness_estimates_jaccard():
    rng, errors = random.Random(1), []
    for _ in range(300):
        n, both = 400, rng.randrange(400)
        a = np.array([rng.getrandbits(64) for _ in range(n)], np.uint64)
        b = np.concatenate([a[:both], np.array([rng.getrandbits(64) for _ in range(n - both)], np.uint64)])
        errors.append(likeness(folded(minima(a)), folded(minima(b))) - both / (2 * n - both))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.045 and max(map(abs, errors)) < 0.18


def test_a_very_long_text(spark):
    rng = random.Random(2)
    rows = [(1, " ".join(str(rng.randrange(10**5)) for _ in range(600_000))), (2, "short text of a few words"), (3, "")]
    assert columns(edited_fingerprints(spark, spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_near_classes_equal_brute_force(spark):
    rng, rows = random.Random(3), []
    for _ in range(30):
        base = [str(rng.randrange(10**6)) for _ in range(rng.choice([3, 40, 90]))]
        for _ in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.randrange(1 + len(words) // 25)):
                words[rng.randrange(len(words))] = "x"
            rows.append(" ".join(words))
    rows = list(enumerate([*rows, "", None, "One two", "one TWO"], 5))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_classes(spark, docs, written(spark, fingerprints(docs))).collect()}
    want = {i: c for i, (_, c, _) in brute_classes(rows, 5).items()}
    assert {i: found.get(i, i) for i, _ in rows} == want and len(set(want.values())) < len(want)


def test_equal_texts_have_equal_fingerprints(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1), (2, "a b c d e f", 2), (None, "A b c d e f", 3), (4, None, 4)], "doc_id long, text string, n_shingles int")
    got = {r.doc_id: r.fingerprint for r in fingerprints(docs).collect()}
    assert got[1] == got[2] == got[None] != "" and got[4] == ""


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    out = op12_fingerprints(spark, "/root/testdata/sf0.001")
    assert columns(out) == brute(rows)
    assert {r.doc_id: (r.n_shingles, r.class_id) for r in out.collect()} == {i: v[:2] for i, v in brute_classes(rows, 5).items()}
