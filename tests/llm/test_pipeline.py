import numpy as np
import public_tokenizers

import corpus_pipeline
from provenant.llm.byte_bpe import library
from provenant.llm.decontaminate import budget, normal
from provenant.llm.pii import all_spans, base_spans, crf_spans, masked, trained
from provenant.llm.quality_rules import quality_rules
from tests.llm.test_decontaminate import distance_anywhere
from tests.llm.test_minhash import brute as components
from tests.llm.test_quality_rules import brute as base_rules

DIR = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    items = [normal(r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    judged = {r.doc_id: r for r in quality_rules(spark.read.parquet(f"{DIR}/documents.parquet")).collect()}
    texts = {i: judged[i].clean_text for i in docs if judged[i].kept}
    assert all(not base_rules(docs[i].text)[5] for i in texts)
    texts = {i: t for i, t in texts.items() if components(sorted(texts.items()), 5)[i][2]} if len(texts) < 5 else dict(kept(texts))
    clean = {}
    for i, t in texts.items():
        n = normal(t)
        # A match within the budget holds a piece unchanged, so texts without any piece need no table.
        near = [x for x in items if any(x[a : a + len(x) // (budget(len(x), 0.08) + 1)] in n for a in cuts(x))]
        if not any(distance_anywhere(x, n) <= budget(len(x), 0.08) for x in near):
            clean[i] = t
    model, enc, want = trained(), library(corpus_pipeline.RANKS, public_tokenizers.PATTERN), {}
    for i, t in clean.items():
        t = masked(t, all_spans(base_spans(t), crf_spans(model, [t])[0], t))
        ids = enc.encode_ordinary(t)
        want[i] = (len(ids), np.array(ids, "<u4").tobytes())
    got = {r.doc_id: (r.n_tokens, bytes(r.ids)) for r in corpus_pipeline.run(spark, DIR).collect()}
    assert got == want and 0 < len(want) < len(docs)


def kept(texts):
    found = components(sorted(texts.items()), 5)
    return [(i, t) for i, t in texts.items() if found[i][2]]


def cuts(x):
    e = budget(len(x), 0.08)
    return [len(x) * k // (e + 1) for k in range(e + 1)]


def test_stages_take_nulls_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "word " * 40, "en", "s", 200), (2, "word " * 40, "en", "s", 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, table, DIR)
            assert k == 4 or out.columns == docs.columns
            out.collect()


def test_near_dedup_judges_rows_not_ids(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(50)) for x in "ab")
    rows = [(1, b), (2, b), (2, a), (None, b), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, DIR).collect()]
    assert sorted(got, key=str) == sorted([(1, b), (2, a), (None, b), (3, None)], key=str)


def test_last_stage_decodes_its_ids(spark):
    texts = {1: "Don't  stop!\n\u00e9 \u65e5", 2: "", 3: "a b " * 500}
    out = corpus_pipeline.byte_bpe(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string"), DIR).collect()
    enc = library(corpus_pipeline.RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: r.decoded for r in out} == texts
    assert all(enc.decode(np.frombuffer(r.ids, "<u4").tolist()) == r.decoded for r in out)


def test_stages_take_clashing_names_ties_and_long_texts(spark):
    import random

    rng = random.Random(1)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(60_000)) + ". Mail a@b.cc."
    prose = "\n".join(" ".join(f"w{rng.randrange(500)}" for _ in range(12)) for _ in range(8))
    schema = "doc_id long, text string, lang string, n_chars long, kept int, n_words string, spans int, text_digest int, component_id int, clean_text string, base_spans int"
    rows = [(i, t, "en", len(t), 10 + i, "n", 20, 30, 40, "c", 50) for i, t in ((1, long), (2, prose), (2, prose), (3, prose))]
    docs = spark.createDataFrame(rows, schema)
    own = lambda r: (r.doc_id, r.kept, r.n_words, r.spans, r.text_digest, r.component_id, r.clean_text, r.base_spans)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DIR)
        assert out.columns == docs.columns
        got = out.collect()
        want = [own(r) for r in docs.collect() if name != "near_dedup" or r.doc_id != 3]
        assert sorted(map(own, got)) == sorted(want), name
        (big,) = [r for r in got if r.doc_id == 1]
        assert big.text == (long.replace("a@b.cc", "<EMAIL>") if name == "pii" else long) and big.n_chars == len(big.text)
    assert {r.doc_id: r.decoded for r in corpus_pipeline.byte_bpe(spark, docs, DIR).collect()}[1] == long
