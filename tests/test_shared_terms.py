import random

import pyarrow as pa
import pytest

from provenant.operators.shared_terms import first_shared, meet


def tables(spark, n=300):
    """Documents with a stop word; some ids occur twice, some texts are null or empty."""
    rng = random.Random(4)
    docs = [(i * 3 % 251, rng.choice([None, "", "...", "The", *(" ".join(["the", *(f"w{int(rng.paretovariate(0.8))}" for _ in range(20))]) for _ in range(30))])) for i in range(n)]
    questions = [(i % 17, rng.choice([None, "", "THE w1 w2 w3 w4 w2", "w5, unknown", "w7 w9 the"])) for i in range(40)]
    return docs, questions


def brute(docs, questions):
    held, asked = {}, {}
    for rows, out in ((docs, held), (questions, asked)):
        for i, text in rows:
            out.setdefault(i, set()).update(w for w in (text or "").lower().replace(",", " ").replace(".", " ").split())
    return {(q, d): n for q, a in asked.items() for d, b in held.items() if (n := len(a & b))}


@pytest.mark.parametrize(("k", "least", "block", "part"), [(3, None, 40, 5), (1, 4, 1000, 1000), (500, None, 16, 100)])
def test_rankings_and_counts_equal_all_pairs(spark, k, least, block, part):
    docs, questions = tables(spark)
    every = brute(docs, questions)
    found = first_shared(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(questions, "item_id long, text string"), k, least, block_docs=block, part_questions=part)
    got = {(r.item_id, r.doc_id): r.score for r in found.collect()}
    assert len(got) == found.count() and got.items() <= every.items()
    for q in {q for q, _ in every}:
        for order in (lambda p: (-every[p], p[1]), lambda p: p[1]):
            assert {*sorted((p for p in every if p[0] == q), key=order)[:k]} <= got.keys()
    assert least is None or {p for p, n in every.items() if n >= least} <= got.keys()


def test_few_pairs_of_a_stop_word_leave_a_task():
    docs = pa.table({"id": pa.array(range(5000)), "words": ["the"] * 5000})
    questions = pa.table({"id": pa.array(range(10)), "words": ["the"] * 10})
    assert len(meet(docs, questions, 50, None)) == 10 * 50
