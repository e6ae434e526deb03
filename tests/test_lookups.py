import random

import pytest
from pyspark.sql import functions as F

from provenant.operators import fuzzy, metrics, responses


def grams(name):
    padded = f"  {name.lower()} "
    return {padded[i : i + 3] for i in range(len(padded) - 2)}


@pytest.mark.parametrize("least", [0.3, 0.5, 0.8, 1.0])
def test_lookup_equals_all_pairs(spark, least):
    rng = random.Random(4)
    names = [(i, "".join(rng.choices("abcd ", k=rng.randrange(1, 14)))) for i in range(250)] + [(900, None), (901, "")]
    queries = []
    for q in range(60):
        name = rng.choice(names[:250])[1]
        i = rng.randrange(len(name))
        queries.append((q, rng.choice([name, name[:i] + name[i + 1 :], name[:i] + "x" + name[i:], "zzz unknown"])))
    queries += [(800, None), (801, "")]
    want = {(q, i): len(grams(a) & grams(b)) / len(grams(a) | grams(b)) for q, a in queries for i, b in names if a is not None and b is not None}
    index = fuzzy.build(spark, spark.createDataFrame(names, "id long, name string"), least)
    found = {(r["query"], r.id): r.similarity for r in fuzzy.lookup(index, spark.createDataFrame(queries, "query long, name string")).collect()}
    assert found == {k: v for k, v in want.items() if v >= least - 1e-9} and (least > 0.8 or len(found) > 20)


def test_common_trigrams_make_no_rows(spark):
    names = spark.range(400).select("id", F.concat(F.lit("common beginning "), F.col("id").cast("string"), F.lit(" x"), (F.col("id") * 7919 % 1000).cast("string")).alias("name"))
    index = fuzzy.build(spark, names, 0.8)
    assert index.prefixes.filter("gram = 'com'").count() == 0 and index.prefixes.count() < 0.5 * index.names.agg(F.sum(F.size("grams"))).first()[0]
    asked = fuzzy.ordered(names.filter("id % 20 = 0"), index.counts)
    assert fuzzy.candidates(index, asked).count() < 0.2 * 20 * 400
    with pytest.raises(ValueError):
        fuzzy.build(spark, names, 0)


def test_lookup_in_blocks_makes_no_row_for_a_shared_trigram(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "BLOCK_NAMES", 70)
    names = spark.range(300).select("id", F.concat(F.lit("part "), F.col("id").cast("string"), F.lit(" of copies")).alias("name"))
    rows = [(r.id, grams(r.name)) for r in names.collect()]
    found = fuzzy.lookup(fuzzy.build(spark, names, 0.8), names.filter("id % 3 = 0").withColumnRenamed("id", "query"))
    assert {(r["query"], r.id) for r in found.collect()} == {(q, i) for q, a in rows if q % 3 == 0 for i, b in rows if len(a & b) / len(a | b) >= 0.8 - 1e-9}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Join" not in plan


def test_redirect_chains(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("s", "s"), *((f"h{i}", f"h{i + 1}") for i in range(6)), ("n", None), (None, "n"), ("m", "z"), ("m", "x")], "src string, dst string")
    starts = spark.createDataFrame([(u,) for u in ["a", "x", "q", "s", "h0", "h3", "n", "m", None, "a"]], "url string")
    got = {r.url: (r.final, r.hops, r.problem) for r in responses.redirect_chains(starts, edges, 3).collect()}
    assert got == {
        "a": ("a", 3, "REDIRECT_LOOP"), "x": ("y", 1, None), "q": ("q", 0, None), "s": ("s", 1, "REDIRECT_LOOP"), "h0": ("h4", 4, "TOO_MANY_REDIRECTS"),
        "h3": ("h6", 3, None), "n": ("n", 0, None), "m": ("y", 2, None),
    }
    short = {r.url: r.problem for r in responses.redirect_chains(starts, edges, 2).collect()}
    assert short["a"] == "TOO_MANY_REDIRECTS" and short["m"] is None  # with three URLs seen, the fourth is not looked at
    assert responses.redirect_chains(starts.limit(0), edges, 3).count() == 0


def test_merged_sketches(spark):
    rng = random.Random(6)
    values = [rng.lognormvariate(0, 1) for _ in range(20_000)]
    rows = spark.createDataFrame([("a", k % 9, v) for k, v in enumerate(values)] + [("b", 0, 4.0), ("b", 1, None)], "route string, day int, value double")
    stored = metrics.sketches(rows, ["route", "day"], "value")
    assert stored.count() == 10
    got = {r.route: r for r in metrics.sketched_percentiles(stored, ["route"]).collect()}
    for q, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
        assert abs(sum(v <= got["a"][name] for v in values) / len(values) - q) < 0.01
    assert got["a"].n == 20_000 and (got["b"].p50, got["b"].n) == (4.0, 1)
