"""Outlier detection: added columns, never dropped rows."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.functions.arrays import EPSILON
from loomframe.operators.contract import require_numeric
from loomframe.operators.fitted import Fitted, transform_of
from loomframe.operators.neighbors import neighbors
from loomframe.plans.quantiles import quantiles
from loomframe.plans.runtime import cut_lineage


def iqr_outliers(df: DataFrame, cols, factor: float = 1.5, approximate: bool = False) -> Fitted:
    """Bounds q1 - 1.5 iqr and q3 + 1.5 iqr per column; transform adds `is_outlier`."""
    require_numeric(df, cols)
    bounds = {}
    for c, (q1, q3) in quantiles(df, cols, [0.25, 0.75], approximate).items():
        if q1 is None or q3 is None:
            raise ValueError(f"no values to fit in {c}")
        bounds[c] = [q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)]
    return Fitted("bounds", {"columns": bounds})


@transform_of("bounds")
def _outside(fit: Fitted, df: DataFrame) -> DataFrame:
    out = F.lit(False)
    for c, (low, high) in fit.options["columns"].items():
        out = out | F.coalesce((F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high)), F.lit(False))
    return df.withColumn("is_outlier", out)


# isolation forest -------------------------------------------------------------------------------------

def _grow(x: np.ndarray, height: int, rng: np.random.Generator) -> list[tuple]:
    """Preorder nodes (feature, value, left, right, depth); feature -1 marks a leaf."""
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, None)]
    while stack:
        rows, depth, parent = stack.pop()
        at = len(nodes)
        if parent is not None:
            nodes[parent[0]][parent[1]] = at
        if depth >= height or len(rows) <= 1:
            nodes.append([-1, 0.0, -1, -1, depth])
            continue
        f = int(rng.integers(x.shape[1]))
        low, high = x[rows, f].min(), x[rows, f].max()
        v = float(rng.uniform(low, high))
        nodes.append([f, v, -1, -1, depth])
        left = x[rows, f] < v
        stack.append((rows[~left], depth + 1, (at, 3)))
        stack.append((rows[left], depth + 1, (at, 2)))
    return [tuple(n) for n in nodes]


class IsolationForest:
    """Random trees on small samples; a short mean path marks an anomaly.

    Trees are grown in parallel, each from its own sample; scoring is one vectorized pass with the forest
    (at most n_trees * 2 * max_samples nodes) broadcast.
    """

    def __init__(self, cols, n_trees: int = 100, max_samples: int = 256, contamination: float = 0.1, seed: int = 42):
        self.cols, self.n_trees, self.max_samples = list(cols), n_trees, max_samples
        self.contamination, self.seed = contamination, seed
        self.nodes = self.threshold = None

    def fit(self, df: DataFrame, id_col: str) -> "IsolationForest":
        require_numeric(df, self.cols)
        n = df.count()
        per_tree = min(self.max_samples, n)
        height = math.ceil(math.log2(per_tree)) if per_tree > 1 else 0
        vec = F.array(*[F.col(c).cast("double") for c in self.cols]).alias("vec")
        slim = df.select(F.col(id_col).alias("id"), vec)
        bags = self._bags(slim, n, per_tree)
        seed = self.seed

        def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["h", "id"]).head(per_tree)
            digest = hashlib.md5(f"{seed}|{key[0]}".encode()).digest()
            rng = np.random.default_rng(int.from_bytes(digest[:8], "big"))
            nodes = _grow(np.stack(pdf["vec"]), height, rng)
            return pd.DataFrame([(key[0], i, *node) for i, node in enumerate(nodes)],
                                columns=["tree", "node", "feature", "value", "left", "right", "depth"])

        grown = bags.groupBy("tree").applyInPandas(
            build, "tree int, node int, feature int, value double, left int, right int, depth int")
        self.nodes = grown.toPandas().sort_values(["tree", "node"])
        scored = cut_lineage(self.score(df).select("path_length"))
        self.threshold = quantiles(scored, ["path_length"], [self.contamination])["path_length"][0]
        return self

    def _bags(self, slim: DataFrame, n: int, per_tree: int) -> DataFrame:
        """(tree, id, vec, h) with at least the per_tree rows of the lowest hash of (seed, tree, id), for every tree.

        Rows above a bound on the hash are left out before anything is shuffled; should a tree be short, the bound grows.
        """
        share = min(1.0, (4 * per_tree + 100) / max(n, 1))
        h = lambda t: F.xxhash64(F.lit(self.seed), t, F.col("id").cast("string"))
        while True:
            bound = F.lit(int(min(2 ** 63 - 1, -(2 ** 63) + share * 2 ** 64))).cast("long")
            trees = F.filter(F.sequence(F.lit(0), F.lit(self.n_trees - 1)), lambda t: h(t) <= bound)
            bags = cut_lineage(slim.withColumn("tree", F.explode(trees)).withColumn("h", h(F.col("tree"))))
            if share >= 1.0 or bags.groupBy("tree").count().filter(F.col("count") >= per_tree).count() == self.n_trees:
                return bags
            share = min(1.0, 4 * share)

    def score(self, df: DataFrame, out: str = "path_length") -> DataFrame:
        """Add the mean path length over all trees."""
        forest = [t[["feature", "value", "left", "right", "depth"]].to_numpy() for _, t in self.nodes.groupby("tree")]
        shared = df.sparkSession.sparkContext.broadcast(forest)

        @F.pandas_udf("double")
        def path(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype="float64") for c in cols])
            total = np.zeros(len(x))
            rows = np.arange(len(x))
            for t in shared.value:
                feature, left, right = t[:, 0].astype(int), t[:, 2].astype(int), t[:, 3].astype(int)
                at = np.zeros(len(x), dtype=int)
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_left = x[rows, np.maximum(f, 0)] < t[at, 1]
                    at = np.where(inner, np.where(go_left, left[at], right[at]), at)
                total += t[at, 4]
            return pd.Series(total / len(shared.value))

        return df.withColumn(out, path(*[F.col(c).cast("double") for c in self.cols]))

    def transform(self, df: DataFrame) -> DataFrame:
        if self.threshold is None:
            raise ValueError("not fitted")
        return self.score(df).withColumn("is_outlier", F.col("path_length") <= F.lit(self.threshold))


# local outlier factor ---------------------------------------------------------------------------------

class LocalOutlierFactor:
    """k-distance, reachability, density ratio; neighbors exclude the point itself, ties go by id."""

    def __init__(self, cols, k: int = 20, contamination: float = 0.1):
        self.cols, self.k, self.contamination = cols, k, contamination
        self.points = self.density = self.scores = self.threshold = None

    def _density(self, near: DataFrame, k_distance: DataFrame) -> DataFrame:
        reach = near.join(k_distance, "point_id").withColumn("reach", F.greatest("distance", "k_distance"))
        return reach.groupBy("query_id").agg((F.lit(float(self.k)) / F.greatest(F.sum("reach"), F.lit(EPSILON))).alias("lrd"))

    def _ratio(self, near: DataFrame, own: DataFrame, density: DataFrame) -> DataFrame:
        other = density.select(F.col("query_id").alias("point_id"), F.col("lrd").alias("other"))
        mean = near.join(other, "point_id").groupBy("query_id").agg(F.avg("other").alias("other"))
        return mean.join(own, "query_id").select("query_id", (F.col("other") / F.col("lrd")).alias("lof"))

    def fit(self, df: DataFrame, id_col: str) -> "LocalOutlierFactor":
        self.points, self.id_col = df, id_col
        near = cut_lineage(neighbors(df, df, id_col, self.cols, self.k, exclude_self=True))
        self.k_distance = near.filter(F.col("rank") == self.k).select(
            F.col("query_id").alias("point_id"), F.col("distance").alias("k_distance"))
        self.density = cut_lineage(self._density(near, self.k_distance))
        self.scores = cut_lineage(self._ratio(near, self.density, self.density))
        self.threshold = quantiles(self.scores, ["lof"], [1 - self.contamination])["lof"][0]
        return self

    def result(self) -> DataFrame:
        """(query_id, lof, is_outlier) of the fitted rows."""
        return self.scores.withColumn("is_outlier", F.col("lof") > F.lit(self.threshold))

    def novelty(self, df: DataFrame, id_col: str | None = None) -> DataFrame:
        """Scores of new rows against the fitted ones."""
        id_col = id_col or self.id_col
        near = cut_lineage(neighbors(df, self.points, id_col, self.cols, self.k, point_id=self.id_col))
        own = self._density(near, self.k_distance)
        return self._ratio(near, own, self.density).withColumn("is_outlier", F.col("lof") > F.lit(self.threshold))
