"""Trees grown level by level.

A level is one aggregation: rows carry their node (a projection over the tree so far), and per (node, feature, value)
a few sums are kept. Running sums along the values give both sides of every split at once. Only the best
split per node comes to the driver.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.plans.ordering import Ordered

NESTED_LEAVES = 256  # larger trees are routed by a vectorized function instead of nested CASE


@dataclass
class Node:
    node: int
    depth: int
    stats: dict = field(default_factory=dict)
    feature: str | None = None
    threshold: float | None = None
    left: int | None = None
    right: int | None = None
    value: list[float] | None = None


class Tree:
    def __init__(self, nodes: list[Node]):
        self.nodes = {n.node: n for n in nodes}

    def route(self, leaf_value: Callable[[Node], Column]) -> Column:
        """A CASE expression from the root to the leaves; x <= threshold goes left, NULL goes right."""
        def at(i: int) -> Column:
            n = self.nodes[i]
            if n.feature is None:
                return leaf_value(n)
            return F.when(F.col(n.feature).cast("double") <= F.lit(n.threshold), at(n.left)).otherwise(at(n.right))

        return at(0)

    def leaf(self) -> Column:
        """Node number of the leaf of a row."""
        if sum(n.feature is None for n in self.nodes.values()) <= NESTED_LEAVES:
            return self.route(lambda n: F.lit(n.node))
        order = sorted(self.nodes)
        place = {i: k for k, i in enumerate(order)}
        names = sorted({n.feature for n in self.nodes.values() if n.feature is not None})
        col = {c: k for k, c in enumerate(names)}
        rows = [self.nodes[i] for i in order]
        feature = np.array([col[n.feature] if n.feature is not None else -1 for n in rows])
        threshold = np.array([n.threshold if n.feature is not None else 0.0 for n in rows])
        left = np.array([place[n.left] if n.feature is not None else 0 for n in rows])
        right = np.array([place[n.right] if n.feature is not None else 0 for n in rows])
        ids = np.array(order)

        @F.pandas_udf("int")
        def walk(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype="float64") for c in cols])
            at, every = np.zeros(len(x), dtype=int), np.arange(len(x))
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    return pd.Series(ids[at], dtype="int32")
                go = x[every, np.maximum(f, 0)] <= threshold[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)

        return walk(*[F.col(c).cast("double") for c in names])

    def score(self, index: int = 0) -> Column:
        """Leaf value (one component)."""
        if sum(n.feature is None for n in self.nodes.values()) <= NESTED_LEAVES:
            return self.route(lambda n: F.lit(float(n.value[index])))
        leaves = [n for n in self.nodes.values() if n.feature is None]
        table = F.create_map(*[v for n in leaves for v in (F.lit(n.node), F.lit(float(n.value[index])))])
        return F.element_at(table, self.leaf())

    def scores(self) -> Column:
        """Leaf value as an array."""
        k = len(next(n.value for n in self.nodes.values() if n.feature is None))
        return F.array(*[self.score(i) for i in range(k)])

    def rows(self) -> list[tuple]:
        return [(n.node, n.feature, n.threshold, n.left, n.right, n.value) for n in sorted(self.nodes.values(), key=lambda n: n.node)]

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            self.rows(), "node int, feature string, threshold double, left int, right int, value array<double>")

    @staticmethod
    def of(table: DataFrame) -> "Tree":
        """A tree from its table of nodes (one row per node)."""
        return Tree([Node(r["node"], 0, {}, r["feature"], r["threshold"], r["left"], r["right"],
                          list(r["value"]) if r["value"] is not None else None) for r in table.collect()])


def upper_edges(df: DataFrame, features, bins: int) -> dict[str, tuple[float, float]]:
    """(low, width) per feature for `bins` equal-width edges."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(features)
                   for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return {c: (row[f"lo{i}"], (row[f"hi{i}"] - row[f"lo{i}"]) / max(bins - 1, 1)) for i, c in enumerate(features)}


def split_points(df: DataFrame, node: Column, features, stats: dict[str, Column], n_rows: int,
                 edges: dict | None = None, subset: dict[int, list[str]] | None = None) -> DataFrame:
    """(node, f, x, l_<stat>...): sums over the rows of the node with feature <= x, for every value or edge."""
    def value(c):
        x = F.col(c).cast("double")
        if edges is None:
            return x
        low, width = edges[c]
        return x if width == 0 else F.lit(low) + F.ceil((x - F.lit(low)) / F.lit(width)) * F.lit(width)

    pairs = F.array(*[F.struct(F.lit(i).alias("f"), value(c).alias("x")) for i, c in enumerate(features)])
    long = df.select(node.alias("node"), *[c.alias(s) for s, c in stats.items()], F.inline(pairs)).filter("x IS NOT NULL")
    if subset is not None:
        index = {c: i for i, c in enumerate(features)}
        allowed = [(n, index[c]) for n, cs in subset.items() for c in cs]
        long = long.join(F.broadcast(df.sparkSession.createDataFrame(allowed, "node int, f int")), ["node", "f"], "left_semi")
    sums = long.groupBy("node", "f", "x").agg(*[F.sum(s).alias(s) for s in stats])
    ordered = Ordered(sums, ["node", "f"], [F.col("x")], F.col("x"), n_rows, derived=True)
    return ordered.running(**{f"l_{s}": ("sum", F.col(s)) for s in stats}).rows()


def best_of(points: DataFrame, gain: tuple[Column, Column], valid: Column, stats) -> DataFrame:
    """Per node the split of largest gain; lowest feature, then lowest value on ties.

    `gain` is (gain, scale): a gain within 1e-14 of the scale counts as zero, others are compared to 12 digits, so that the choice
    does not depend on the unit of the target.
    """
    value, scale = gain
    unit = F.pow(F.lit(10.0), F.ceil(F.log10(F.abs(value))).cast("double"))
    value = F.when(F.abs(value) <= 1e-14 * scale, 0.0).otherwise(F.round(value / unit, 12) * unit)
    ranked = F.struct(value.alias("gain"), (-F.col("f")).alias("f"), (-F.col("x")).alias("x"),
                      *[F.col(f"l_{s}") for s in stats])
    return (points.filter(valid).groupBy("node").agg(F.max(ranked).alias("b"))
            .select("node", F.col("b.gain").alias("gain"), (-F.col("b.f")).alias("f"), (-F.col("b.x")).alias("x"),
                    *[F.col(f"b.l_{s}").alias(f"l_{s}") for s in stats]))


def with_totals(points: DataFrame, nodes: list[Node], stats) -> DataFrame:
    """Add t_<stat>, the sums of the whole node (a short table from the driver; literals for a single node)."""
    if len(nodes) == 1:
        return points.select("*", *[F.lit(float(nodes[0].stats[s])).alias(f"t_{s}") for s in stats])
    rows = [(n.node, *[float(n.stats[s]) for s in stats]) for n in nodes]
    schema = "node int, " + ", ".join(f"t_{s} double" for s in stats)
    return points.join(F.broadcast(points.sparkSession.createDataFrame(rows, schema)), "node")


def feature_count(max_features, p: int) -> int:
    if max_features is None:
        return p
    if max_features == "sqrt":
        return max(1, int(math.sqrt(p)))
    if max_features == "log2":
        return max(1, int(math.log2(p)))
    if isinstance(max_features, float):
        return max(1, int(max_features * p))
    if isinstance(max_features, int):
        return min(p, max_features)
    raise ValueError(f"unknown max_features {max_features!r}")


def grow(df: DataFrame, features, stats: dict[str, Column], gain: Callable, valid: Callable, leaf: Callable,
         splittable: Callable, max_depth: int, accept: Callable = lambda g: True, bins: int | None = None,
         max_features=None, seed: int = 42) -> Tree:
    """Grow one tree. gain (with its scale) and valid are Columns of l_<stat> and t_<stat>; leaf and splittable look at a node's sums."""
    features = list(features)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in features], *[c.cast("double").alias(s) for s, c in stats.items()])
    names = list(stats)
    row = data.agg(F.count("*").alias("_rows"), *[F.sum(s).alias(s) for s in names]).first()
    n_rows = row["_rows"]
    if n_rows == 0:
        raise ValueError("cannot grow a tree on an empty table")
    root = Node(0, 0, {s: row[s] for s in names})
    nodes, open_nodes = [root], [root]
    edges = upper_edges(data, features, bins) if bins else None
    own = {s: F.col(s) for s in names}
    k = feature_count(max_features, len(features))
    while open_nodes:
        todo = [n for n in open_nodes if n.depth < max_depth and splittable(n.stats)]
        open_nodes = []
        if not todo:
            break
        subset = None
        if k < len(features):
            subset = {}
            for n in todo:
                digest = hashlib.md5(f"{seed}|{n.node}".encode()).digest()
                rng = np.random.default_rng(int.from_bytes(digest[:8], "big"))
                subset[n.node] = [features[i] for i in rng.choice(len(features), k, replace=False)]
        at = Tree(nodes).leaf().cast("int")
        level = data.withColumn("_at", at).filter(F.col("_at").isin([n.node for n in todo])) if len(nodes) > 1 \
            else data.withColumn("_at", F.lit(0))
        points = with_totals(split_points(level, F.col("_at"), features, own, n_rows, edges, subset), todo, names)
        found = {r["node"]: r for r in best_of(points, gain(), valid(), names).collect()}
        for n in todo:
            r = found.get(n.node)
            if r is None or not accept(r["gain"]):
                continue
            left = Node(len(nodes), n.depth + 1, {s: r[f"l_{s}"] for s in names})
            right = Node(len(nodes) + 1, n.depth + 1, {s: n.stats[s] - r[f"l_{s}"] for s in names})
            n.feature, n.threshold, n.left, n.right = features[r["f"]], r["x"], left.node, right.node
            nodes += [left, right]
            open_nodes += [left, right]
    for n in nodes:
        n.value = leaf(n.stats)
    return Tree(nodes)
