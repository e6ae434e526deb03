import collections
import random
import re

from provenant.llm.quality_rules import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    places = collections.defaultdict(list)
    for k in range(len(words) - 7):
        places[tuple(words[k : k + 8])].append(k)
    covered = {i for v in places.values() if len(v) > 1 for k in v for i in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n)


def test_base_columns_equal_brute_force(spark):
    rng = random.Random(3)
    parts = ["a", "b", "the", "é", "日本", " ", "  ", "\n", "\t", "\x0b", "#", "|", "<>", " ", ".", "\n\n"]
    texts = [None, "", " ", "\n", "one", "x " * 30, "a b c d e f g h " * 2, "a b c d e f g h"]
    texts += ["".join(rng.choices(parts, k=rng.randrange(120))) for _ in range(200)]
    texts += [" ".join(rng.choices("abc", k=rng.randrange(60))) for _ in range(100)]
    texts += [" ".join(str(rng.randrange(3000)) for _ in range(20000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules(docs).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(texts[r.doc_id]), texts[r.doc_id]
        assert r.kept in (True, False)


def test_lines_are_removed_and_losing_documents_rejected(spark):
    clean = "\n".join(f"Line {i} tells of thing{i} and then of place{i} calmly." for i in range(6))
    nav = "Home | News | Sports | Contact"
    junk = "\n".join(f"part{i}### token{i}&&& other{i}%%% more{i}***" for i in range(9))
    rows = [
        (1, clean), (2, clean + "\n" + nav + "\nAll rights reserved."), (3, junk), (4, "\n".join(f"A{i} | B{i} | C{i}" for i in range(20))),
        (5, " ".join(f"WORD{i}!!" for i in range(40))), (6, clean + "\n\n-----\n"), (7, clean.replace("\n", " ")), (8, " ".join(f"w{i}" for i in range(300))),
    ]
    out = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k for k, r in out.items() if r.kept} == {1, 2, 6, 7, 8}
    assert out[2].clean_text == clean and out[2].n_lines_removed == 2
    assert out[6].clean_text == clean + "\n\n"
    assert out[1].clean_text == clean and out[1].chars_removed == 0


def test_rows_and_clashing_columns(spark):
    rows = [(1, "a b", "x", True), (1, "a b", "x", True), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _words string, kept boolean")
    out = quality_rules(docs)
    assert out.columns[:3] == ["doc_id", "text", "_words"]
    assert out.count() == 3 and out.columns.count("kept") == 1 and out.filter("kept").count() == 0
    assert quality_rules(docs.limit(0)).count() == 0


def test_plan_has_no_python_and_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_query_equals_brute_force(spark):
    from provenant.llm.quality_rules import op4_quality_rules

    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op4_quality_rules(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, 6, 7)], "doc_id long, text string, __quality_words int, __quality_kept int, kept int")
    row = quality_rules(docs).first()
    assert (row["__quality_words"], row["__quality_kept"], row.kept, row.n_words) == (5, 6, False, 3)
