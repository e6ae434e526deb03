import random

from provenant.llm import components
from provenant.llm.components import connected


def test_equals_search(spark):
    rng = random.Random(3)
    for n, m in ((30, 25), (60, 40), (12, 60)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(100, 140)] + [(200, 200)]
        label = {x: x for e in edges for x in e}
        for _ in label:
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        got = connected(spark, spark.createDataFrame(edges, "a long, b long")).collect()
        assert {r.node: r.label for r in got} == label and len(got) == len(label)
    assert connected(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_path_in_any_order(spark, monkeypatch):
    rounds, one = [], components.contracted
    monkeypatch.setattr(components, "contracted", lambda edges: rounds.append(1) or one(edges))
    rng = random.Random(11)
    nodes = rng.sample(range(10**6), 3000)
    edges = [rng.sample(pair, 2) for pair in zip(nodes, nodes[1:])]
    got = connected(spark, spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == dict.fromkeys(nodes, min(nodes)) and len(got) == len(nodes)
    assert len(rounds) < 30
