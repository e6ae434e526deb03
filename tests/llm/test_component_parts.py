import random

import numpy as np

from provenant.llm import components
from provenant.llm.components import connected, stars


def searched(edges):
    label = {x: x for e in edges for x in e}
    while True:
        before = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def test_stars():
    rng = random.Random(5)
    for n, m in ((1, 1), (30, 25), (400, 380), (50, 600)):
        edges = [(rng.randrange(n) - 10, rng.randrange(n) - 10) for _ in range(m)] + [(n - k, n - k - 1) for k in range(20)]
        nodes, labels = stars(*np.array(edges, np.int64).T)
        assert dict(zip(nodes.tolist(), labels.tolist(), strict=True)) == searched(edges)


def test_edges_of_one_part_take_no_rounds(spark, monkeypatch):
    rounds, one = [], components.contracted
    monkeypatch.setattr(components, "contracted", lambda edges: rounds.append(1) or one(edges))
    edges = [(k % 97, k) for k in range(2000)] + [(5000 + k, 5001 + k) for k in range(500)]
    random.Random(2).shuffle(edges)
    table = spark.createDataFrame(edges, "a long, b long").repartition(9)
    got = connected(spark, table).collect()
    assert {r.node: r.label for r in got} == searched(edges) and len(got) == len(searched(edges))
    assert not rounds


def test_parts_are_joined(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(200)] + [(2000, 2000 + k) for k in range(100)]
    rng.shuffle(edges)
    for part_edges in (7, 100):
        got = connected(spark, spark.createDataFrame(edges, "a long, b long"), part_edges).collect()
        assert {r.node: r.label for r in got} == searched(edges) and len(got) == len(searched(edges))


def test_long_path_over_parts(spark, monkeypatch):
    rounds, one = [], components.contracted
    monkeypatch.setattr(components, "contracted", lambda edges: rounds.append(1) or one(edges))
    rng = random.Random(11)
    nodes = rng.sample(range(10**6), 1500)
    edges = [rng.sample(pair, 2) for pair in zip(nodes, nodes[1:])]
    rng.shuffle(edges)
    got = connected(spark, spark.createDataFrame(edges, "a long, b long"), 50).collect()
    assert {r.node: r.label for r in got} == dict.fromkeys(nodes, min(nodes)) and len(got) == len(nodes)
    assert len(rounds) < 30
