"""Ledger, graph and evaluation rules where one key holds most rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from provenant.operators import graph, metrics, ranks, versions
from provenant.sources.ledger import OBSERVATIONS
from tests.test_ledger import log, sequential


@pytest.mark.parametrize("stretches", [1, 3, 64])
def test_numbers_and_running_maxima_equal_one_pass(spark, stretches):
    rng = random.Random(stretches)
    seqs = rng.sample(range(10_000), 500)
    rows = [(rng.choice(["hot"] * 8 + ["a", None]), s, rng.choice([None, rng.randrange(100)])) for s in seqs]
    frame = spark.createDataFrame(rows, "k string, s long, v long")
    last, count, most, want = {}, {}, {}, {}
    for k, s, v in sorted(rows, key=lambda r: r[1]):
        count[k] = count.get(k, 0) + 1
        top = max((x for x in (most.get(k), v) if x is not None), default=None)
        want[s] = (count[k], last.get(k), top)
        last[k], most[k] = v, top
    got = ranks.running_max(ranks.numbered(frame, ["k"], "s", "v", "no", "previous", stretches), ["k"], "s", "v", "top", stretches)
    assert {r.s: (r.no, r.previous, r.top) for r in got.collect()} == want
    assert ranks.numbered(frame.limit(0), ["k"], "s", "v", "no", "previous").count() == 0


def test_a_hot_document_url_and_null_hash(spark):
    """Most rows are of one document at one URL, half of them 304 answers: equal to the ledger row by row, in many groups."""
    rng = random.Random(9)
    rows = [(i, rng.choice(["d"] * 9 + ["e"]), rng.choice(["u"] * 9 + ["v"]), "r", rng.choice([None, f"h{rng.randrange(200)}"]), 1) for i in range(1500)]
    obs = spark.createDataFrame(rows, OBSERVATIONS)
    want = sequential(rows)
    assert sorted((r.seq, r.outcome) for r in versions.outcomes(obs).collect()) == [(s, o) for s, o, _, _ in want]
    assert {r.seq: r.hash for r in versions.resolved_304(obs).collect()} == {s: h for s, _, h, _ in want if h and rows[s][4] is None}
    numbers = {}
    for s, o, h, _ in want:
        if o == "NEW_VERSION":
            numbers.setdefault(rows[s][1], []).append(h)
    got = {(r.doc, r.version_no): (r.hash, r.previous_hash) for r in versions.versions(obs).collect()}
    assert got == {(d, n): (h, hs[n - 2] if n > 1 else None) for d, hs in numbers.items() for n, h in enumerate(hs, 1)}
    plan = versions.outcomes(obs)._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(hash" in plan  # 304 answers go their own way, past the joins on the hash
    assert versions.outcomes(spark.createDataFrame(log(1, 5), OBSERVATIONS).filter("hash is null")).filter("outcome <> 'FAILED_PERMANENT'").count() == 0


def walk(edges, root, depth, fan_out, nodes):
    """Breadth first, row by row."""
    seen, front, cut = {root: 0}, [root], False
    for d in range(1, depth + 1):
        reached = set()
        for n in front:
            targets = sorted({b for a, b in edges if a == n})
            cut |= len(targets) > fan_out
            reached |= {t for t in targets[:fan_out] if t not in seen}
        room = nodes - len(seen)
        cut |= len(reached) > room
        front = sorted(reached)[: max(room, 0)]
        seen |= dict.fromkeys(front, d)
    return {(root, n, d, cut) for n, d in seen.items()}


@pytest.mark.parametrize("nodes", [1, 4, 9, 1000])
def test_traversal_with_a_cap_on_nodes(spark, nodes):
    rng = random.Random(nodes)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(150)] + [(0, k) for k in range(500, 1500)]
    frame = spark.createDataFrame(edges, "src long, dst long")
    roots = spark.createDataFrame([(r,) for r in (0, 3, 7, 99)], "root long")
    got = {tuple(r) for r in graph.reachable(frame, roots, 3, 6, False, nodes).collect()}
    assert got == set().union(*(walk(edges, r, 3, 6, nodes) for r in (0, 3, 7, 99)))


def test_edges_of_a_hot_node_are_cut_by_shares(spark):
    edges = spark.range(5000).select(F.lit(1).alias("src"), F.col("id").alias("dst")).union(spark.createDataFrame([(2, 5), (2, 6)], "src int, dst long"))
    got = [(r.src, r.dst, r.truncated) for r in graph.capped_edges(edges, 3).orderBy("src", "dst").collect()]
    assert got == [(1, 0, True), (1, 1, True), (1, 2, True), (2, 5, False), (2, 6, False)]


def test_bootstrap_weights_equal_their_sql(spark):
    keys = [0, 1, 7, 10**6 + 5, 2**40]
    frame = spark.createDataFrame([(k,) for k in keys], "k long").select("k", *(F.expr(metrics.draw("k", i, 7)).alias(f"d{i}") for i in range(12)))
    rows = {r.k: r for r in frame.select("k", *(F.expr(metrics.weight(i)).alias(f"w{i}") for i in range(12))).collect()}
    assert metrics.weights(np.array(keys), 12, 7).tolist() == [[rows[k][f"w{i}"] for i in range(12)] for k in keys]
