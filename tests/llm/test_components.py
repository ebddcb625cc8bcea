import random

from hazeline.llm.components import connected_components


def brute(edges):
    root = {}
    for a, b in edges:
        for x in (a, b):
            root.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            for x in (a, b):
                changed |= root[x] != low
                root[x] = low
    return root


def test_random_graphs_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)]
    edges += [(1000 + i, 1001 + i) for i in range(100)] + [(5000, 5001 + i) for i in range(200)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges + [(None, 3), (4, None)], "a long, b long")).collect()}
    expected = brute([e for e in edges if e[0] != e[1]])
    assert found == expected


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
