"""Gaussian naive Bayes and linear discriminant analysis."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.functions.arrays import with_softmax
from loomframe.operators.contract import require_numeric
from loomframe.operators.fitted import Fitted, transform_of
from loomframe.operators.linear import linear_expression, moments
from loomframe.plans.runtime import settle

# Fixed value: smallest variance used in scoring.
VARIANCE_FLOOR = 1e-9


def gaussian_nb_fit(df: DataFrame, cols, label: str) -> Fitted:
    """Table `params`: (class, prior, m_<col>, v_<col>) with population variances."""
    require_numeric(df, cols)
    stats = [f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("v", F.var_pop))]
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count("*").alias("n"), *stats)
    params = counts.select("class", (F.col("n") / F.lit(float(df.count()))).alias("prior"),
                           *[f"{n}_{c}" for c in cols for n in ("m", "v")])
    return Fitted("gaussian_nb", {"cols": list(cols)}, {"params": settle(params)})


@transform_of("gaussian_nb")
def _gaussian_nb(fit: Fitted, df: DataFrame) -> DataFrame:
    """Add `probabilities` (sorted classes) and `prediction`; the class table becomes literals."""
    rows = fit.tables["params"].df.orderBy("class").collect()  # one row per class
    scores = []
    for r in rows:
        s = F.lit(math.log(r["prior"]))
        for c in fit.options["cols"]:
            v = max(r[f"v_{c}"], VARIANCE_FLOOR)
            d = F.col(c).cast("double") - F.lit(r[f"m_{c}"])
            s = s + F.lit(-0.5 * math.log(2.0 * math.pi * v)) - d * d / F.lit(2.0 * v)
        scores.append(s)
    return with_softmax(df, scores, [r["class"] for r in rows])


class Discriminant:
    """Class means, within and between scatter; linear scores and generalized eigenvectors."""

    def __init__(self, cols, label: str, shrinkage: float | None = None, n_components: int | None = None):
        self.cols, self.label, self.shrinkage, self.n_components = list(cols), label, shrinkage, n_components

    def fit(self, df: DataFrame) -> "Discriminant":
        require_numeric(df, self.cols)
        parts = moments(df, self.cols, by=self.label)
        self.classes = sorted(parts)
        n = sum(m.n for m in parts.values())
        p = len(self.cols)
        self.means = np.array([parts[c].mean for c in self.classes])
        self.priors = np.array([parts[c].n / n for c in self.classes])
        self.within = sum(m.n * m.cov for m in parts.values())
        overall = self.priors @ self.means
        diff = self.means - overall
        self.between = (diff * (self.priors * n)[:, None]).T @ diff
        within, pooled = self.within, self.within / max(n - len(self.classes), 1)
        if self.shrinkage is not None:
            within = (1 - self.shrinkage) * within + self.shrinkage * np.eye(p)
            pooled = (1 - self.shrinkage) * pooled + self.shrinkage * np.eye(p)
        self.coef = np.linalg.solve(pooled, self.means.T)  # p x classes
        self.intercept = -0.5 * np.sum(self.means.T * self.coef, axis=0) + np.log(self.priors)
        k = self.n_components or min(p, len(self.classes) - 1)
        # generalized eigenvectors of (between, within) through the inverse root of within
        values, vectors = np.linalg.eigh(within)
        root = vectors @ np.diag(1.0 / np.sqrt(values)) @ vectors.T
        ev, ew = np.linalg.eigh(root @ self.between @ root)
        scalings = root @ ew[:, np.argsort(ev)[::-1][:k]]
        largest = np.argmax(np.abs(scalings), axis=0)
        self.scalings = scalings * np.sign(scalings[largest, np.arange(k)])
        return self

    def scatter(self, spark) -> DataFrame:
        """(i, j, within, between) of the feature pairs."""
        rows = [(self.cols[i], self.cols[j], float(self.within[i, j]), float(self.between[i, j]))
                for i in range(len(self.cols)) for j in range(len(self.cols))]
        return spark.createDataFrame(rows, "i string, j string, within double, between double")

    def transform(self, df: DataFrame, prefix: str = "component_") -> DataFrame:
        return df.select("*", *[linear_expression(self.cols, self.scalings[:, j], 0.0).alias(f"{prefix}{j}")
                                for j in range(self.scalings.shape[1])])

    def predict(self, df: DataFrame) -> DataFrame:
        scores = [linear_expression(self.cols, self.coef[:, j], self.intercept[j]) for j in range(len(self.classes))]
        return with_softmax(df, scores, self.classes)
