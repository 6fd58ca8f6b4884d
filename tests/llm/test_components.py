import random

from tidewater.llm.components import components


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200, 200), (300, 301), (301, 300), (301, 302)] + [(rng.randint(400, 600), rng.randint(400, 600)) for _ in range(80)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
