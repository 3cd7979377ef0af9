"""Distances found 64 sources at a time equal those of a plain search."""

from collections import deque

import numpy as np
import pytest

from loomframe.operators import graph


def plain(n, edges):
    near = {v: set() for v in range(n)}
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    total = 0
    for s in near:
        at, queue = {s: 0}, deque([s])
        while queue:
            v = queue.popleft()
            for w in near[v] - at.keys():
                at[w] = at[v] + 1
                queue.append(w)
        total += sum(d - 1 for d in at.values() if d)
    return total / ((n - 1) * (n - 2) * n)


@pytest.mark.parametrize("limit", [100_000, 10], ids=["in tasks", "by joins"])
def test_betweenness_of_more_than_64_sources(spark, limit):
    ring = [(i, (i + 1) % 70) for i in range(70)] + [(0, i) for i in range(70, 130)] + [(3, 3), (1, 0), (140, 141)]
    edges = spark.createDataFrame([(1, a, b) for a, b in ring], "graph_id long, src long, dst long")
    nodes = spark.range(150).selectExpr("1L AS graph_id", "id AS node")
    spark.conf.set("spark.loomframe.broadcastRows", limit)
    if limit == 10:
        spark.conf.set("spark.loomframe.blockRows", 1)  # three batches of 64 sources
    try:
        assert graph.avg_betweenness(edges, nodes).first()["avg_betweenness"] == pytest.approx(plain(150, ring))
    finally:
        spark.conf.unset("spark.loomframe.broadcastRows")
        spark.conf.unset("spark.loomframe.blockRows")


def test_sources_are_searched_in_the_order_they_meet(monkeypatch):
    """A ring of shuffled numbers: neighbors share a long, so a level reaches few places; any number of groups at once gives the same sum."""
    n = 1000
    ring = np.random.default_rng(1).permutation(n)
    near = {v: (ring[i - 1], ring[(i + 1) % n]) for i, v in enumerate(ring)}
    starts, tails = np.arange(n + 1) * 2, np.array([w for v in range(n) for w in near[v]])
    met = graph._met_order(starts, tails)
    assert sorted(met) == list(range(n))
    at = np.empty(n, int)
    at[met] = np.arange(n)
    assert max(abs(at[v] - at[w]) for v in near for w in near[v]) == 2
    for places in (1, 5_000, 2_000_000):
        monkeypatch.setattr(graph, "SEARCH_PLACES", places)
        assert graph._distances(starts, tails, met) == n * (2 * sum(range(499)) + 499)
    assert graph._distances(starts, tails, met[[5, 5, 7]]) == 3 * (2 * sum(range(499)) + 499)


def test_repeated_nodes_count_as_often_as_they_occur(spark):
    edges = spark.createDataFrame([(1, 0, 1), (1, 1, 2)], "graph_id long, src long, dst long")
    nodes = spark.createDataFrame([(1, 0), (1, 0), (1, 1), (1, 2)], "graph_id long, node long")
    assert graph.avg_betweenness(edges, nodes).first()["avg_betweenness"] == pytest.approx((1 + 1 + 1) / (3 * 2 * 4))
