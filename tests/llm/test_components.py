"""Components against a plain search, and what a round shuffles."""

import random

import pytest

from termtide.llm import components

EDGES = "a bigint, b bigint"


def random_edges():
    rnd = random.Random(6)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)]
    edges += [(400, x) for x in range(401, 440)] + [(499, x) for x in range(450, 480)]
    edges += [(x, x + 1) for x in range(600, 640)] + [(7, 7), (None, 3), (4, None), (None, None)]
    return edges + edges[:50] + [(b, a) for a, b in edges[50:90]]


def plain_components(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


@pytest.mark.parametrize("least_hot", [512, 3])
def test_components_with_hubs(spark, monkeypatch, least_hot):
    monkeypatch.setattr(components, "LEAST_HOT", least_hot, raising=False)
    edges = random_edges()
    got = components.connected_components(spark.createDataFrame(edges, EDGES)).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.component for r in got} == plain_components(edges)


def test_a_round_shuffles_edges_twice(spark, monkeypatch):
    shuffles, cut = [], components.cut

    def counted(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles.append(plan.count("Exchange hashpartitioning"))
        return cut(df, label)

    monkeypatch.setattr(components, "cut", counted)
    components.connected_components(spark.createDataFrame(random_edges(), EDGES)).count()
    assert len(shuffles) > 2 and max(shuffles[1:]) <= 2
