import random

from provenant.llm import decontaminate
from provenant.llm.decontaminate import Matcher, budget, contaminated, myers, normal


def distance_anywhere(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def noisy(rng, text, n):
    text = list(text)
    for _ in range(n):
        at = rng.randrange(len(text))
        kind = rng.randrange(3)
        if kind == 0:
            text[at] = rng.choice("xyz")
        elif kind == 1:
            del text[at]
        else:
            text.insert(at, rng.choice("xyz"))
    return "".join(text)


def test_myers_equals_the_table():
    rng = random.Random(1)
    for _ in range(400):
        p = "".join(rng.choices("abc", k=rng.randrange(1, 70)))
        t = "".join(rng.choices("abc", k=rng.randrange(0, 120)))
        d, found = distance_anywhere(p, t), myers(p, t, len(p) - 1)
        assert (found[0] if found else len(p)) == d


def test_matcher_finds_all_within_the_budget():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 8))) for _ in range(80)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(3, 40)))) for i in range(25)]
    matcher = Matcher(items, 0.08)
    for _ in range(120):
        i, item = rng.choice(items)
        text = " ".join(rng.choices(words, k=30)) + " " + noisy(rng, item, rng.randrange(1 + int(len(item) * 0.12))) + " " + " ".join(rng.choices(words, k=30))
        text = normal(text)
        got = {h[0]: h for h in matcher.hits(text)}
        for j, other in items:
            d = distance_anywhere(other, text)
            if d <= budget(len(other), 0.08):
                assert got[j][1] == d
                assert distance_anywhere(other, text[got[j][2] : got[j][3]]) == d
            else:
                assert j not in got


def test_rows(spark, monkeypatch):
    item = "The quick brown fox jumps over the lazy dog, and then it sleeps in the sun."
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, " "), (5, "short one")], "item_id long, text string")
    rows = [(10, f"xx {item.upper()} yy"), (10, f"xx {item.upper()} yy"), (None, item.replace("quick", "quikc")), (11, None), (12, ""), (13, "clean text. " * 30000), (14, "a short  one.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", docs_item())
    want = sorted([("10", 1, 0), ("10", 2, 0)] * 2 + [("None", 1, 2), ("None", 2, 2), ("14", 5, 0)])
    for chars in (1 << 20, 60):
        monkeypatch.setattr(decontaminate, "PART_CHARS", chars)
        assert sorted((str(r.doc_id), r.item_id, r.distance) for r in contaminated(spark, docs, bench).collect()) == want
    assert contaminated(spark, docs, bench.limit(0)).count() == 0 == contaminated(spark, docs.limit(0), bench).count()


def docs_item():
    from pyspark.sql import functions as F

    return F.lit("x")


def test_null_ids(spark):
    text = "the quick brown fox jumps over the lazy dog again"
    docs = spark.createDataFrame([(1, text), (None, text)], "doc_id long, text string")
    items = spark.createDataFrame([(None, text), (-1, text)], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in contaminated(spark, docs, items).collect()), key=str)
    assert got == sorted([(1, None), (1, -1), (None, None), (None, -1)], key=str)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: normal(r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: normal(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = {}
    for i, pattern in items.items():
        e = budget(len(pattern), decontaminate.EDIT_SHARE)
        cuts = [len(pattern) * k // (e + 1) for k in range(e + 2)]
        for d, text in texts.items():
            # Within the budget a piece is unchanged; texts without any need no table.
            if any(pattern[a:b] in text for a, b in zip(cuts, cuts[1:], strict=False)) and (n := distance_anywhere(pattern, text)) <= e:
                want[d, i] = n
    got = decontaminate.op8_decontaminate(spark, sf).collect()
    assert want and {(r.doc_id, r.item_id): r.distance for r in got} == want and len(got) == len(want)
    assert all(distance_anywhere(items[r.item_id], texts[r.doc_id][r.start : r.end]) == r.distance for r in got)
