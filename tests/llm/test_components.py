from __future__ import annotations

import random

from skyledger.llm.components import connected


def test_components_match_union_find(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a long chain
    edges += [(5000, 2000 + i) for i in range(300)]  # a hub
    edges += [(7, 7), (None, 3), edges[0], edges[1][::-1]]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    found = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r["node"], r["root"]) for r in found) == sorted((x, find(x)) for x in list(root))
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
