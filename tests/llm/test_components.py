"""Connected components against union-find on random graphs, chains and stars."""

import numpy as np
import pytest

from provisio.llm.components import components


def roots(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


r = np.random.default_rng(1)
GRAPHS = {
    "random": [tuple(map(int, p)) for p in r.integers(0, 300, (220, 2))],
    "chain": [(k, k + 1) for k in range(60)],
    "star": [(k, 500) for k in range(100)] + [(500, 499), (499, 1000)],
    "stars": [(k, k % 7) for k in range(7, 200)],
    "empty": [],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    pairs = [p for p in GRAPHS[name] if p[0] != p[1]]
    df = spark.createDataFrame([*GRAPHS[name], *pairs[:3], (None, 1), (2, 2)], "a long, b long")
    assert {x["id"]: x["component"] for x in components(df).collect()} == roots(pairs)
