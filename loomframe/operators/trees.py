"""Split search, decision trees, forests and boosting."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.contract import require_numeric
from loomframe.operators.split import subsample
from loomframe.plans.forest import Grown, grow_forest, leaves
from loomframe.plans.levelwise import Node, Tree, best_of, grow, split_points, with_totals
from loomframe.plans.runtime import cut_lineage

# Fixed value: the second-order gain and leaf use this regularization.
REG = 1.0


def _impurity(kind: str, counts: list[Column], n: Column) -> Column:
    if kind == "gini":
        return 1.0 - reduce(lambda a, b: a + b, [(c / n) * (c / n) for c in counts])
    if kind == "entropy":
        return reduce(lambda a, b: a + b, [F.when(c > 0, -(c / n) * F.log2(c / n)).otherwise(0.0) for c in counts])
    raise ValueError("criterion must be 'gini' or 'entropy'")


class _ClassSplit:
    """Gain over class counts c0..cK-1."""

    def __init__(self, classes, label: str, criterion: str, min_leaf: int):
        self.classes, self.kind, self.min_leaf = classes, criterion, min_leaf
        self.stats = {f"c{i}": (F.col(label) == F.lit(c)).cast("double") for i, c in enumerate(classes)}

    def _side(self, p):
        counts = [F.col(f"{p}_{s}") for s in self.stats]
        return counts, reduce(lambda a, b: a + b, counts)

    def _sides(self):
        (left, nl), (total, n) = self._side("l"), self._side("t")
        return left, nl, [t - x for t, x in zip(total, left)], n - nl, total, n

    def gain(self) -> tuple[Column, Column]:
        left, nl, right, nr, total, n = self._sides()
        return (_impurity(self.kind, total, n) - nl / n * _impurity(self.kind, left, nl)
                - nr / n * _impurity(self.kind, right, nr)), F.lit(1.0)

    def valid(self) -> Column:
        _, nl, _, nr, _, _ = self._sides()
        return (nl >= self.min_leaf) & (nr >= max(self.min_leaf, 1))


class _SquareSplit:
    """Least sum of squared errors over n, s = sum y, ss = sum y^2 (the gain is the decrease)."""

    def __init__(self, y: Column, min_leaf: int):
        self.min_leaf = min_leaf
        self.stats = {"n": F.lit(1.0), "s": y, "ss": y * y}

    def gain(self) -> tuple[Column, Column]:
        # sum of squared errors = ss - s^2 / n; ss is the same for all splits of a node
        nl, sl, n, s = F.col("l_n"), F.col("l_s"), F.col("t_n"), F.col("t_s")
        return sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n, F.col("t_ss")

    def valid(self) -> Column:
        return (F.col("l_n") >= self.min_leaf) & (F.col("t_n") - F.col("l_n") >= max(self.min_leaf, 1))


class _GradientSplit:
    """Second-order gain over g and h sums."""

    def __init__(self, g: Column, h: Column):
        self.stats = {"n": F.lit(1.0), "g": g, "h": h}

    def gain(self) -> tuple[Column, Column]:
        gl, hl, g, h = F.col("l_g"), F.col("l_h"), F.col("t_g"), F.col("t_h")
        part = lambda a, b: a * a / (b + REG)
        both = part(gl, hl) + part(g - gl, h - hl)
        return both - part(g, h), both + part(g, h)

    def valid(self) -> Column:
        return F.col("t_n") - F.col("l_n") >= 1


def _search(df: DataFrame, features, rule, accept_zero: bool) -> DataFrame:
    data = df.select(*[F.col(c).cast("double").alias(c) for c in features],
                     *[c.cast("double").alias(s) for s, c in rule.stats.items()])
    names = list(rule.stats)
    row = data.agg(F.count("*").alias("_rows"), *[F.sum(s).alias(s) for s in names]).first()
    root = Node(0, 0, {s: row[s] for s in names})
    points = with_totals(split_points(data, F.lit(0), features, {s: F.col(s) for s in names}, row["_rows"]), [root], names)
    best = best_of(points, rule.gain(), rule.valid(), names)
    if not accept_zero:
        best = best.filter("gain > 0")
    return best.select(F.element_at(F.lit(list(features)), F.col("f") + 1).alias("feature"),
                       F.col("x").alias("threshold"), "gain")


def classes_of(df: DataFrame, label: str, most: int = 1000) -> list:
    found = [r[0] for r in df.select(label).distinct().orderBy(label).limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} classes in {label}")
    return found


def best_split(df: DataFrame, features, label: str, criterion: str = "gini", min_samples_leaf: int = 1) -> DataFrame:
    """(feature, threshold, gain): the best x <= threshold over all values of all features."""
    require_numeric(df, features)
    return _search(df, features, _ClassSplit(classes_of(df, label), label, criterion, min_samples_leaf), True)


def best_split_regression(df: DataFrame, features, target: str, min_samples_leaf: int = 1) -> DataFrame:
    """The split with the least squared error; the gain is its decrease."""
    require_numeric(df, features)
    return _search(df, features, _SquareSplit(F.col(target).cast("double"), min_samples_leaf), True)


def best_split_second_order(df: DataFrame, features, g: str, h: str) -> DataFrame:
    require_numeric(df, features)
    return _search(df, features, _GradientSplit(F.col(g), F.col(h)), False)


def gradient_histogram(df: DataFrame, features, g: str, h: str, bins: int = 255) -> DataFrame:
    """(feature, bin, g, h): sums per equal-width bin; bin i holds edge[i-1] <= x < edge[i] of `bins` edges."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(features)
                   for n, f in (("lo", F.min), ("hi", F.max))]).first()
    pairs = []
    for i, c in enumerate(features):
        lo, hi = row[f"lo{i}"], row[f"hi{i}"]
        b = F.lit(bins) if lo == hi else F.floor((F.col(c) - F.lit(lo)) / F.lit((hi - lo) / (bins - 1))).cast("int") + 1
        pairs.append(F.struct(F.lit(c).alias("feature"), b.cast("int").alias("bin")))
    long = df.select(F.col(g).alias("_g"), F.col(h).alias("_h"), F.inline(F.array(*pairs)))
    return long.groupBy("feature", "bin").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"))


class DecisionTreeClassifier:
    def __init__(self, features, label: str, criterion: str = "gini", max_depth: int = 5, min_samples_split: int = 2,
                 min_samples_leaf: int = 1, max_features=None, bins: int | None = None, seed: int = 42):
        self.__dict__.update(locals())
        self.tree: Tree | None = None

    def fit(self, df: DataFrame) -> "DecisionTreeClassifier":
        require_numeric(df, self.features)
        self.classes = classes_of(df, self.label)
        rule = _ClassSplit(self.classes, self.label, self.criterion, self.min_samples_leaf)
        size = lambda s: sum(s.values())
        self.tree = grow(
            df, self.features, rule.stats, rule.gain, rule.valid,
            leaf=lambda s: [v / size(s) for v in s.values()],
            splittable=lambda s: size(s) >= self.min_samples_split and sum(v > 0 for v in s.values()) > 1,
            max_depth=self.max_depth, bins=self.bins, max_features=self.max_features, seed=self.seed)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `probabilities` (classes in sorted order) and `prediction`."""
        scored = df.withColumn("probabilities", self.tree.scores())
        at = F.array_position("probabilities", F.array_max("probabilities")).cast("int")
        return scored.withColumn("prediction", F.element_at(F.lit(self.classes), at))


class DecisionTreeRegressor:
    def __init__(self, features, target: str, max_depth: int = 5, min_samples_split: int = 2,
                 min_samples_leaf: int = 1, max_features=None, bins: int | None = None, seed: int = 42):
        self.__dict__.update(locals())
        self.tree: Tree | None = None

    def fit(self, df: DataFrame) -> "DecisionTreeRegressor":
        require_numeric(df, self.features)
        rule = _SquareSplit(F.col(self.target).cast("double"), self.min_samples_leaf)
        self.tree = grow(
            df, self.features, rule.stats, rule.gain, rule.valid, leaf=lambda s: [s["s"] / s["n"]],
            splittable=lambda s: s["n"] >= self.min_samples_split and s["ss"] - s["s"] ** 2 / s["n"] > 1e-12 * s["ss"],
            max_depth=self.max_depth, bins=self.bins, max_features=self.max_features, seed=self.seed)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.tree.score())


def tree_score(df: DataFrame, tree: DataFrame, out: str = "value") -> DataFrame:
    """Leaf value (array) of each row for a table of nodes (node, feature, threshold, left, right, value)."""
    return df.withColumn(out, Tree.of(tree).scores())


class RandomForest:
    """Bagged trees with random features; the mean of the trees' probabilities decides.

    A bag is a Poisson(1) weight per row and tree. Features are cut into at most `bins` bins (each value its own if there are
    no more values), and a node looks at `max_features` of them. NULL goes right at every split.
    """

    def __init__(self, features, label: str, id_col: str, n_trees: int = 100, max_depth: int = 10, max_features="sqrt",
                 min_samples_split: int = 2, min_samples_leaf: int = 1, criterion: str = "gini", seed: int = 42, bins: int = 64):
        if criterion not in ("gini", "entropy"):
            raise ValueError("criterion must be 'gini' or 'entropy'")
        self.__dict__.update(locals())
        self.trees: list[Grown] = []

    def fit(self, df: DataFrame) -> "RandomForest":
        require_numeric(df, self.features)
        # the trees' leaves, which the driver holds, have a number for each class
        found = df.select(self.label).filter(F.col(self.label).isNotNull()).distinct().orderBy(self.label)
        self.classes = [r[0] for r in found.collect()]
        code = F.array_position(F.lit(self.classes), F.col(self.label)) - 1
        self.trees, self.edges = grow_forest(
            df, self.features, code, len(self.classes), self.id_col, self.n_trees, self.max_depth, self.max_features,
            self.min_samples_split, self.min_samples_leaf, self.criterion, self.bins, self.seed)
        return self

    def table(self, spark) -> DataFrame:
        """A row per node: tree, node (1 is the root, 2 n and 2 n + 1 are the children of n), feature, threshold, class weights."""
        rows = [(t, g.heap[i], self.features[g.feature[i]] if g.feature[i] >= 0 else None,
                 float(self.edges[g.feature[i]][g.code[i]]) if g.feature[i] >= 0 else None, [float(v) for v in g.weights[i]])
                for t, g in enumerate(self.trees) for i in range(len(g.feature))]
        return spark.createDataFrame(rows, "tree int, node long, feature string, threshold double, weights array<double>")

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `probabilities` (classes in sorted order) and `prediction`."""
        walks = []
        for g in self.trees:
            feature, code, left, right = g.arrays()
            limit = np.array([self.edges[f][c] if f >= 0 else 0.0 for f, c in zip(feature, code)])
            weights = np.array(g.weights)
            walks.append(((feature, limit, left, right), weights / np.maximum(weights.sum(axis=1, keepdims=True), 1)))

        @F.pandas_udf("array<double>")
        def predict(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype="float64") for c in cols])
            return pd.Series(list(sum(p[leaves(arrays, x)] for arrays, p in walks) / len(walks)))

        scored = df.withColumn("probabilities", predict(*[F.col(c).cast("double") for c in self.features]))
        best = F.array_position("probabilities", F.array_max("probabilities")).cast("int")
        return scored.withColumn("prediction", F.element_at(F.lit(self.classes), best))


class Boosting:
    """F = 0; each round fits a tree to y - F and adds learning_rate * tree.

    method 'squares': least-squares trees with mean leaves; 'second_order': gradient gain on exact values;
    'histogram': the same gain on equal-width bins. Leaves of the last two are sum g / (sum h + 1).
    """

    def __init__(self, features, target: str, n_trees: int = 100, learning_rate: float = 0.1, max_depth: int = 3,
                 min_samples_split: int = 2, subsample: float = 1.0, method: str = "squares", bins: int | None = None,
                 seed: int = 42, cut_every: int = 5):
        if method not in ("squares", "second_order", "histogram"):
            raise ValueError("method must be squares, second_order or histogram")
        self.__dict__.update(locals())
        if method == "histogram" and bins is None:
            self.bins = 255
        self.trees: list[Tree] = []

    def _tree(self, data: DataFrame) -> Tree:
        residual = F.col("_y") - F.col("_f")
        if self.method == "squares":
            rule = _SquareSplit(residual, 1)
            leaf, accept = (lambda s: [s["s"] / s["n"]]), (lambda g: True)
            enough = lambda s: s["n"] >= self.min_samples_split and s["ss"] - s["s"] ** 2 / s["n"] > 1e-12 * s["ss"]
        else:
            rule = _GradientSplit(residual, F.lit(1.0))
            leaf, accept = (lambda s: [s["g"] / (s["h"] + REG)]), (lambda g: g > 0)
            enough = lambda s: s["n"] >= self.min_samples_split
        return grow(data, self.features, rule.stats, rule.gain, rule.valid, leaf, enough, self.max_depth, accept, self.bins)

    def fit(self, df: DataFrame, id_col: str | None = None) -> "Boosting":
        require_numeric(df, self.features)
        if self.subsample < 1.0 and id_col is None:
            raise ValueError("subsampling needs an id column")
        keep = [F.col(id_col).alias("_id")] if id_col else []
        state = df.select(*keep, *self.features, F.col(self.target).cast("double").alias("_y"), F.lit(0.0).alias("_f"))
        state = cut_lineage(state)  # the columns needed, written once; every level of every tree reads them
        self.trees = []
        for i in range(self.n_trees):
            data = state if self.subsample >= 1.0 else cut_lineage(subsample(state, "_id", self.subsample, self.seed + i))
            tree = self._tree(data)
            self.trees.append(tree)
            state = state.withColumn("_f", F.col("_f") + F.lit(self.learning_rate) * tree.score())
            if (i + 1) % self.cut_every == 0 and i + 1 < self.n_trees:
                state = cut_lineage(state)
        return self

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        total = reduce(lambda a, b: a + b, [F.lit(self.learning_rate) * t.score() for t in self.trees])
        return df.withColumn(out, total)
