"""Connected components: the smallest node names each, and no round is run for edges that point to their roots already."""

import numpy as np

from flowlens.llm import common


def _want(edges):
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for u, v in edges:
        if u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    return {i: root(i) for i in parent}


def _got(spark, edges):
    rows = common.connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert len(rows) == len({r.node for r in rows})
    return {r.node: r.component for r in rows}


def test_rounds_end_with_the_last_open_node(spark, monkeypatch):
    tables, cut = [], common.cut
    monkeypatch.setattr(common, "cut", lambda *a: tables.append(1) or cut(*a))
    pairs = [(-4, 9), (9, -4), (3, 5), (7, 3), (3, 3), (8, 8)]
    assert _got(spark, pairs) == _want(pairs) == {-4: -4, 9: -4, 3: 3, 5: 3, 7: 3}
    assert len(tables) == 1  # stars: nothing but the edges themselves is written
    assert _got(spark, []) == {}
    del tables[:]
    path = [(1, 2), (2, 3)]
    assert _got(spark, path) == {1: 1, 2: 1, 3: 1}
    assert len(tables) == 1 + 4  # one round


def test_components_of_long_paths_and_random_graphs(spark):
    rng = np.random.default_rng(11)
    ids = rng.permutation(40).tolist()
    edges = list(zip(ids[:20], ids[1:21])) + [(100 + int(a), 100 + int(b)) for a, b in rng.integers(0, 60, (45, 2))]
    assert _got(spark, edges) == _want(edges)
