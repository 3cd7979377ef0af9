"""Forests against a plain Python forest over the same weights and features."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.functions.keys import hash_key, poisson_one, uniform
from loomframe.operators.trees import RandomForest
from loomframe.plans import forest


def table(spark, n=400, classes=3, seed=1, hot=0.0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    y = ((x[:, 0] > 6).astype(int) + (x[:, 1] + rng.integers(0, 4, n) > 9)) % classes
    h = int(n * hot)
    x[:h], y[:h] = x[0], y[0]
    rows = [(i, *map(float, v), f"c{c}") for i, (v, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y string"), x, y


def plain_trees(x, y, weights, k, depth, seed, kind="gini", min_leaf=1):
    """{(tree, node): (feature, threshold)} by trying all splits."""
    n_classes = y.max() + 1

    def unlike(c):
        p = c / c.sum()
        return 1 - (p ** 2).sum() if kind == "gini" else -sum(v * np.log2(v) for v in p if v > 0)

    out = {}
    for t in range(weights.shape[1]):
        todo = [(1, np.flatnonzero(weights[:, t] > 0), 0)]
        while todo:
            node, rows, d = todo.pop()
            count = lambda r: np.bincount(y[r], weights=weights[r, t], minlength=n_classes)
            total = count(rows)
            if d == depth or total.sum() < 2 or (total > 0).sum() < 2:
                continue
            some = sorted(range(x.shape[1]), key=lambda f: hashlib.md5(f"{seed}|{t}|{node}|{f}".encode()).hexdigest())[:k]
            best = None
            for f in sorted(some):
                for v in np.unique(x[rows, f]):
                    left = rows[x[rows, f] <= v]
                    a = count(left)
                    b = total - a
                    if a.sum() < min_leaf or b.sum() < max(min_leaf, 1):
                        continue
                    gain = round(unlike(total) - a.sum() / total.sum() * unlike(a) - b.sum() / total.sum() * unlike(b), 12)
                    if best is None or gain > best[0]:
                        best = (gain, f, v, left)
            if best:
                out[t, node] = best[1:3]
                todo += [(2 * node, best[3], d + 1), (2 * node + 1, np.setdiff1d(rows, best[3]), d + 1)]
    return out


def weights_of(df, n_trees, seed=42):
    cols = [poisson_one(uniform(hash_key(seed, F.lit(t), "id"))).alias(f"w{t}") for t in range(n_trees)]
    return np.array([[r[f"w{t}"] for t in range(n_trees)] for r in df.select("id", *cols).orderBy("id").collect()])


@pytest.mark.parametrize("kind,cells,hot", [("gini", 4_000_000, 0.0), ("entropy", 10, 0.0), ("gini", 10, 0.35)])
def test_trees_equal_a_plain_forest(spark, monkeypatch, kind, cells, hot):
    monkeypatch.setattr(forest, "CELLS", cells)  # both ways to hold a task's sums
    df, x, y = table(spark, hot=hot)
    fit = RandomForest(["a", "b", "c"], "y", "id", n_trees=4, max_depth=4, max_features=2, criterion=kind, min_samples_leaf=3).fit(df.repartition(5))
    got = {(r.tree, r.node): ("abc".index(r.feature), r.threshold) for r in fit.table(spark).collect() if r.feature}
    assert got == plain_trees(x, y, weights_of(df, 4), 2, 4, 42, kind, 3)


def test_scores_are_means_over_trees(spark):
    df, x, y = table(spark)
    fit = RandomForest(["a", "b", "c"], "y", "id", n_trees=6, max_depth=5, max_features=None).fit(df)
    nodes = {(r.tree, r.node): r for r in fit.table(spark).collect()}
    for r in fit.transform(df).limit(60).collect():
        total = np.zeros(3)
        for t in range(6):
            node = 1
            while nodes[t, node].feature:
                node = 2 * node + (r[nodes[t, node].feature] > nodes[t, node].threshold)
            w = np.array(nodes[t, node].weights)
            total += w / w.sum() / 6
        np.testing.assert_allclose(r.probabilities, total, atol=1e-12)
        assert r.prediction == f"c{np.argmax(total)}"
    hit = fit.transform(df).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert hit > 0.9


def test_many_classes(spark):
    """Two thousand classes: no limit, for classes are rows of the aggregation."""
    df = spark.range(6000).select("id", (F.col("id") % 2000).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 2000).alias("y"))
    fit = RandomForest(["a", "b"], "y", "id", n_trees=2, max_depth=3, max_features=None, bins=16).fit(df)
    assert len(fit.classes) == 2000
    assert fit.table(spark).filter("feature = 'a'").count() >= 6


def test_bins_nulls_and_faults(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 == 0, None).otherwise(F.sin("id")).alias("a"), F.lit(1.0).alias("b"),
                                  F.when(F.col("id") % 10 == 0, "none").when(F.sin("id") > 0, "up").otherwise("down").alias("y"))
    edges = forest.bin_edges(df, ["a", "b"], 32)
    assert len(edges[0]) == 32 and list(edges[1]) == [1.0]
    fit = RandomForest(["a", "b"], "y", "id", n_trees=5, max_depth=3, max_features=None, bins=32).fit(df)
    out = fit.transform(df)
    assert out.filter("y = 'none' AND prediction = 'none'").count() == 300
    assert out.filter("y = prediction").count() > 2850
    with pytest.raises(ValueError):
        RandomForest(["a"], "y", "id").fit(df.limit(0))
    with pytest.raises(ValueError):
        RandomForest(["a"], "y", "id", bins=1).fit(df)


def test_weights_are_drawn_once_and_rows_go_as_matrices(spark):
    """The weights that a task draws are those of keys.poisson_one, from eight digits of a hash that is taken once a row and tree."""
    df, _, _ = table(spark, n=300)
    edges = forest.bin_edges(df, ["a", "b", "c"], 64)
    made = forest.prepared(df, ["a", "b", "c"], F.lit(1), "id", 7, 42, edges).collect()
    wanted = sorted(bytes(w.astype(np.uint8)) for w in weights_of(df, 7))
    assert sorted(bytes(r.w) for r in made) == wanted
    rows = np.arange(24, dtype=np.uint16).reshape(8, 3)
    column = forest._binary(rows)
    assert (forest._matrix(column.slice(2, 5), np.uint16, 3) == rows[2:7]).all()
    lots = list(forest._gathered(iter([]), 3, 2))
    assert lots == []
