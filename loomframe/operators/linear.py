"""Linear models from distributed moments, gradient fits and Spark's own solvers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.functions.arrays import EPSILON, with_softmax
from loomframe.operators.contract import require_numeric
from loomframe.operators.fitted import Fitted, transform_of
from loomframe.plans.runtime import require_columns

BUILTIN_MOMENTS = 20  # up to this many columns the moments are built-in aggregates
BLOCK = 512  # columns of one block of a covariance matrix, 2 MB


@dataclass
class Moments:
    """Count, means and population covariance of some columns; moments of disjoint parts add up."""

    n: float
    mean: np.ndarray
    cov: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        return self._merge(other, 1)

    def __sub__(self, other: "Moments") -> "Moments":
        return self._merge(other, -1)

    def _merge(self, other, sign):
        n = self.n + sign * other.n
        mean = (self.n * self.mean + sign * other.n * other.mean) / n
        # second moments around the common mean keep the subtraction stable
        a, b = self.mean - mean, other.mean - mean
        cov = (self.n * (self.cov + np.outer(a, a)) + sign * other.n * (other.cov + np.outer(b, b))) / n
        return Moments(n, mean, cov)


def moments(df: DataFrame, cols, by: str | None = None) -> dict:
    """Moments of complete rows, per value of `by` (key None without it). One aggregation, p^2 / 2 numbers.

    Many columns: each partition's covariance is cut into blocks, which executors merge in two rounds, by about the root of
    the number of partitions; a row per key and block reaches the driver, whatever the number of partitions.
    """
    require_columns(df, cols)
    p = len(cols)
    keys = [by] if by else []
    data = df.select(*keys, *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)]).dropna(
        subset=[f"_{i}" for i in range(p)])
    if p <= BUILTIN_MOMENTS:
        aggs = [F.count("*").alias("n"), *[F.avg(f"_{i}").alias(f"m{i}") for i in range(p)]]
        aggs += [F.covar_pop(f"_{i}", f"_{j}").alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)]
        rows = data.groupBy(*keys).agg(*aggs).collect()
        out = {}
        for r in rows:
            if r["n"] == 0:
                continue
            cov = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)], dtype=float)
            out[r[by] if by else None] = Moments(r["n"], np.array([r[f"m{i}"] for i in range(p)], dtype=float), cov)
        return out
    return _blocked_moments(data, p, by)


def _blocked_moments(data: DataFrame, p: int, by: str | None) -> dict:
    names = [f"_{i}" for i in range(p)]
    key = data.schema[by].dataType.simpleString() if by else "int"
    cuts = list(range(0, p, BLOCK))

    def blocks(key, m: Moments) -> pd.DataFrame:
        at = [(i, j) for i in cuts for j in cuts if i <= j]
        return pd.DataFrame({
            "k": [key] * len(at), "i": [i for i, _ in at], "j": [j for _, j in at], "n": [float(m.n)] * len(at),
            "mean_i": [m.mean[i:i + BLOCK] for i, _ in at], "mean_j": [m.mean[j:j + BLOCK] for _, j in at],
            "cov": [m.cov[i:i + BLOCK, j:j + BLOCK].ravel() for i, j in at]})

    def partial(batches):
        acc: dict = {}
        for pdf in batches:
            parts = pdf.groupby(by, sort=False, dropna=False) if by else [(0, pdf)]
            for key, part in parts:
                x = part[names].to_numpy(dtype="float64")
                if len(x):
                    m = Moments(len(x), x.mean(axis=0), np.cov(x, rowvar=False, bias=True).reshape(p, p))
                    acc[key] = acc[key] + m if key in acc else m
        for key, m in acc.items():
            yield blocks(key, m)

    def merged(batches):
        """Sums of blocks that come sorted by key and place, one at a time."""
        held, last = None, None
        for pdf in batches:
            for k, i, j, n, a, b, cov in zip(*(pdf[c] for c in ("k", "i", "j", "n", "mean_i", "mean_j", "cov"))):
                now = (None if pd.isna(k) else k, i, j)
                if last is not None and now != last:
                    yield row(last, held)
                    held = None
                last, cov = now, cov.reshape(len(a), len(b))
                if held is None:
                    held = [n, a.copy(), b.copy(), cov.copy()]
                    continue
                total = held[0] + n
                to, da, db = n / total, a - held[1], b - held[2]
                held[3] += (cov - held[3]) * to + np.outer(da, db) * to * (1 - to)
                held[0], held[1], held[2] = total, held[1] + da * to, held[2] + db * to
        if last is not None:
            yield row(last, held)

    def row(place, held):
        return pd.DataFrame({"k": [place[0]], "i": [place[1]], "j": [place[2]], "n": [held[0]], "mean_i": [held[1]],
                             "mean_j": [held[2]], "cov": [held[3].ravel()]})

    schema = f"k {key}, i int, j int, n double, mean_i array<double>, mean_j array<double>, cov array<double>"
    slots = max(1, int(data.rdd.getNumPartitions() ** 0.5))
    parts = data.mapInPandas(partial, schema).withColumn("slot", F.spark_partition_id() % slots)
    parts = parts.repartition("k", "i", "j", "slot").sortWithinPartitions("k", "i", "j", "slot").drop("slot").mapInPandas(merged, schema)
    parts = parts.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j").mapInPandas(merged, schema)
    out: dict = {}
    for r in parts.toLocalIterator():
        m = out.setdefault(r["k"] if by else None, Moments(r["n"], np.zeros(p), np.zeros((p, p))))
        i, j = r["i"], r["j"]
        cov = np.array(r["cov"]).reshape(len(r["mean_i"]), len(r["mean_j"]))
        m.mean[i:i + BLOCK], m.mean[j:j + BLOCK] = r["mean_i"], r["mean_j"]
        m.cov[i:i + BLOCK, j:j + BLOCK], m.cov[j:j + BLOCK, i:i + BLOCK] = cov, cov.T
    return out


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        return np.linalg.pinv(a) @ b


def ridge_weights(m: Moments, alpha: float, fit_intercept: bool = True) -> tuple[np.ndarray, float]:
    """(X'X / n + .01 alpha I) w = X'y / n with the last column as y; the intercept is not penalized."""
    if fit_intercept:
        w = _solve(m.cov[:-1, :-1] + 0.01 * alpha * np.eye(len(m.mean) - 1), m.cov[:-1, -1])
        return w, float(m.mean[-1] - w @ m.mean[:-1])
    second = m.cov + np.outer(m.mean, m.mean)
    return _solve(second[:-1, :-1] + 0.01 * alpha * np.eye(len(m.mean) - 1), second[:-1, -1]), 0.0


def linear_fit(df: DataFrame, cols, target: str, alpha: float = 0.0, l1_ratio: float = 0.0,
               fit_intercept: bool = True, out: str = "prediction", max_iter: int = 200, tol: float = 1e-9) -> Fitted:
    """Half the mse + .01 alpha (r |w|_1 + (1 - r) |w|^2 / 2): OLS, ridge (r = 0), lasso (r = 1), elastic net."""
    require_numeric(df, [*cols, target])
    if alpha == 0 or l1_ratio == 0:
        found = moments(df, [*cols, target])
        if not found:
            raise ValueError("no complete rows to fit")
        w, b = ridge_weights(found[None], alpha, fit_intercept)
    else:
        data = VectorAssembler(inputCols=list(cols), outputCol="_x", handleInvalid="skip").transform(
            df.select(*cols, F.col(target).cast("double").alias("_y")))
        model = LinearRegression(featuresCol="_x", labelCol="_y", regParam=0.01 * alpha, elasticNetParam=l1_ratio,
                                 standardization=False, fitIntercept=fit_intercept, maxIter=max_iter, tol=tol).fit(data)
        w, b = model.coefficients.toArray(), model.intercept
    return Fitted("linear", {"cols": list(cols), "weights": [float(v) for v in w], "intercept": float(b), "out": out})


def linear_expression(cols, weights, intercept):
    s = F.lit(float(intercept))
    for c, w in zip(cols, weights):
        s = s + (F.col(c).cast("double") if isinstance(c, str) else c) * F.lit(float(w))
    return s


@transform_of("linear")
def _linear(fit: Fitted, df: DataFrame) -> DataFrame:
    o = fit.options
    return df.withColumn(o["out"], linear_expression(o["cols"], o["weights"], o["intercept"]))


# gradient descent -------------------------------------------------------------------------------------

def optimizer(name: str, lr: float | None = None, eps: float = EPSILON):
    """A step function (params, gradient) -> params with its own zero state. Steps count from 1."""
    # Default rates and decay constants of the update rules.
    rates = {"sgd": 0.01, "adam": 0.001, "momentum": 0.01, "rmsprop": 0.001, "adagrad": 0.01, "adamax": 0.002, "nadam": 0.002}
    if name not in rates:
        raise ValueError(f"optimizer must be one of {sorted(rates)}")
    b1, b2, rho, mu = 0.9, 0.999, 0.9, 0.9
    lr = rates[name] if lr is None else lr
    memory = {"t": 0, "a": 0.0, "b": 0.0}

    def step(w, g):
        memory["t"] += 1
        t = memory["t"]
        if name == "sgd":
            return w - lr * g
        if name == "momentum":
            memory["a"] = mu * memory["a"] - lr * g
            return w + memory["a"]
        if name == "rmsprop":
            memory["a"] = rho * memory["a"] + (1 - rho) * g * g
            return w - lr * g / (np.sqrt(memory["a"]) + eps)
        if name == "adagrad":
            memory["a"] = memory["a"] + g * g
            return w - lr * g / (np.sqrt(memory["a"]) + eps)
        memory["a"] = b1 * memory["a"] + (1 - b1) * g
        if name == "adamax":
            memory["b"] = np.maximum(b2 * memory["b"], np.abs(g))
            return w - lr * memory["a"] / (memory["b"] + eps)
        memory["b"] = b2 * memory["b"] + (1 - b2) * g * g
        first, second = memory["a"] / (1 - b1 ** t), memory["b"] / (1 - b2 ** t)
        if name == "nadam":
            first = b1 * first + (1 - b1) * g
        return w - lr * first / (np.sqrt(second) + eps)

    return step


@dataclass
class GradientFit:
    weights: np.ndarray  # (p, outputs)
    intercept: np.ndarray
    history: list[float]
    loss: str
    cols: list[str]
    classes: list | None = None

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        scores = [linear_expression(self.cols, self.weights[:, j], self.intercept[j]) for j in range(self.weights.shape[1])]
        if self.loss == "elastic_net":
            return df.withColumn(out, scores[0])
        if self.loss == "hinge":
            return df.withColumn("decision", scores[0]).withColumn(out, F.when(F.col("decision") >= 0, 1).otherwise(-1))
        return with_softmax(df, scores, self.classes, out)


def gradient_fit(df: DataFrame, cols, label: str, loss: str = "elastic_net", method: str = "adam", lr: float | None = None,
                 max_iter: int = 100, tol: float = 1e-6, alpha: float = 0.1, l1_ratio: float = 0.2, C: float = 0.01,
                 validation: DataFrame | None = None, patience: int = 5) -> GradientFit:
    """Full-batch descent from zero weights: a distributed sum of gradients, a driver update of p numbers.

    The squared loss needs one pass only: all its gradients follow from the moments. With validation rows, descent
    stops after `patience` steps without a better validation loss.
    """
    require_numeric(df, cols)
    cols, p = list(cols), len(cols)
    if loss == "elastic_net":
        return _descend_moments(df, cols, label, method, lr, max_iter, tol, alpha, l1_ratio, validation, patience)
    if loss not in ("softmax", "hinge"):
        raise ValueError("loss must be elastic_net, softmax or hinge")
    df = df.filter(F.col(label).isNotNull())
    classes = [r[0] for r in df.select(label).distinct().orderBy(label).collect()]
    if loss == "softmax":
        index = (F.array_position(F.lit(classes), F.col(label)) - 1).cast("double")
        k = len(classes)
    else:
        if len(classes) != 2:
            raise ValueError("hinge loss needs two classes")
        index = F.when(F.col(label) == F.lit(classes[1]), 1.0).otherwise(-1.0)
        k = 1
    x = [F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)]
    data = df.select(*x, index.alias("_y")).dropna().persist()
    names = [f"_{i}" for i in range(p)]
    w, b = np.zeros((p, k)), np.zeros(k)
    step_w, step_b = optimizer(method, lr), optimizer(method, lr)
    history, n_params = [], p * k + k + 2
    try:
        for _ in range(max_iter):
            def partial(batches, w=w, b=b):
                acc = np.zeros(n_params)
                for pdf in batches:
                    if not len(pdf):
                        continue
                    m, y = pdf[names].to_numpy(), pdf["_y"].to_numpy()
                    scores = m @ w + b
                    if loss == "softmax":
                        e = np.exp(scores - scores.max(axis=1, keepdims=True))
                        prob = e / e.sum(axis=1, keepdims=True)
                        at = (np.arange(len(y)), y.astype(int))
                        value = -np.log(np.maximum(prob[at], EPSILON)).sum()
                        prob[at] -= 1.0
                        d = prob
                    else:
                        margin = y[:, None] * scores
                        value = np.maximum(0.0, 1.0 - margin).sum()
                        d = np.where(margin < 1, -y[:, None], 0.0)
                    acc += np.concatenate([(m.T @ d).ravel(), d.sum(axis=0), [value, len(y)]])
                yield pd.DataFrame({"g": [acc]})

            sums = data.mapInPandas(partial, "g array<double>").agg(
                F.array(*[F.sum(F.col("g")[i]) for i in range(n_params)]).alias("g")).first()["g"]
            g = np.array(sums)
            n = g[-1]
            history.append(float(g[-2] / n + 0.5 * C * (w * w).sum()))
            w = step_w(w, g[:p * k].reshape(p, k) / n + C * w)
            b = step_b(b, g[p * k:p * k + k] / n)
            if len(history) > 1 and abs(history[-2] - history[-1]) < tol:
                break
    finally:
        data.unpersist()
    return GradientFit(w, b, history, loss, cols, classes)


def _descend_moments(df, cols, label, method, lr, max_iter, tol, alpha, l1_ratio, validation, patience) -> GradientFit:
    found = moments(df, [*cols, label])
    held = moments(validation, [*cols, label])[None] if validation is not None else None
    m = found[None]
    w, b = np.zeros(len(cols)), 0.0
    step_w, step_b = optimizer(method, lr), optimizer(method, lr)

    def half_mse(s: Moments, w, b):
        c = np.append(-w, 1.0)
        return 0.5 * (c @ s.cov @ c + (c @ s.mean - b) ** 2)

    history, best, since = [], float("inf"), 0
    for _ in range(max_iter):
        history.append(float(half_mse(m, w, b) + 0.01 * alpha * (l1_ratio * np.abs(w).sum() + 0.5 * (1 - l1_ratio) * (w * w).sum())))
        if held is not None:
            v = half_mse(held, w, b)
            best, since = (v, 0) if v < best else (best, since + 1)
            if since >= patience:
                break
        if len(history) > 1 and abs(history[-2] - history[-1]) < tol:
            break
        c = np.append(-w, 1.0)
        off = c @ m.mean - b  # mean residual
        grad = -(m.cov[:-1] @ c) - m.mean[:-1] * off
        w = step_w(w, grad + 0.01 * alpha * (l1_ratio * np.sign(w) + (1 - l1_ratio) * w))
        b = step_b(b, -off)
    return GradientFit(w.reshape(-1, 1), np.array([b]), history, "elastic_net", cols)


# Spark's solvers --------------------------------------------------------------------------------------

class _Solved:
    """A pyspark.ml classifier on named columns with any label type."""

    def __init__(self, estimator, cols, label: str):
        self.estimator, self.cols, self.label, self.model = estimator, list(cols), label, None

    def _assembled(self, df):
        return VectorAssembler(inputCols=self.cols, outputCol="_x").transform(df)

    def fit(self, df: DataFrame):
        df = df.filter(F.col(self.label).isNotNull())
        self.classes = [r[0] for r in df.select(self.label).distinct().orderBy(self.label).collect()]
        index = (F.array_position(F.lit(self.classes), F.col(self.label)) - 1).cast("double")
        self.model = self.estimator.setFeaturesCol("_x").setLabelCol("_y").fit(
            self._assembled(df.select(*self.cols, index.alias("_y"))))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.model.setPredictionCol("_p").setRawPredictionCol("_r")
        probable = hasattr(out, "setProbabilityCol")
        if probable:
            out = out.setProbabilityCol("_pr")
        scored = out.transform(self._assembled(df))
        if probable:
            scored = scored.withColumn("probabilities", vector_to_array("_pr")).drop("_pr")
        else:
            scored = scored.withColumn("decision", vector_to_array("_r")[1])
        return scored.withColumn("prediction", F.element_at(F.lit(self.classes), F.col("_p").cast("int") + 1)).drop("_x", "_p", "_r")


def softmax_classifier(cols, label: str, C: float = 0.01, max_iter: int = 100) -> _Solved:
    """Multinomial logistic regression with the penalty C |W|^2 / 2."""
    return _Solved(LogisticRegression(family="multinomial", elasticNetParam=0.0, regParam=C, standardization=False,
                                      maxIter=max_iter), cols, label)


def linear_svm(cols, label: str, reg: float = 0.01, max_iter: int = 100) -> _Solved:
    """Mean hinge loss with the penalty reg |w|^2 / 2; adds `decision`."""
    return _Solved(LinearSVC(regParam=reg, maxIter=max_iter, standardization=False), cols, label)


def softmax_score(df: DataFrame, cols, weights, bias, classes=None) -> DataFrame:
    """Add `probabilities` and `prediction` for given weights (p x classes) and bias."""
    w = np.asarray(weights, dtype=float)
    scores = [linear_expression(cols, w[:, j], bias[j]) for j in range(w.shape[1])]
    return with_softmax(df, scores, classes)


def harmonic_regression(df: DataFrame, x: str, y: str, n_components: int = 20, frequencies=None, alpha: float = 0.0,
                        out: str = "prediction") -> Fitted:
    """y as a sum of a_k sin(2 pi f_k x + p_k): least squares on sine and cosine columns.

    Frequencies default to n_components steps from 0 to n // 2. alpha > 0 puts an L1 penalty on the parts.
    """
    if frequencies is None:
        frequencies = list(np.linspace(0, df.count() // 2, n_components))
    fit = Fitted("harmonic", {"x": x, "frequencies": [float(f) for f in frequencies], "weights": [], "intercept": 0.0, "out": out})
    design, cols = _design(fit, df.select(x, F.col(y).alias("_y")))
    # .01 alpha r in the linear model equals alpha / 2 here, where the loss is the whole mean square
    inner = linear_fit(design, cols, "_y", 50.0 * alpha, 1.0 if alpha else 0.0)
    fit.options.update(weights=inner.options["weights"], intercept=inner.options["intercept"])
    return fit


def _design(fit: Fitted, df: DataFrame):
    import math

    made, names = [], []
    for i, f in enumerate(fit.options["frequencies"]):
        if f == 0:
            continue  # a constant: the intercept
        angle = F.lit(2.0 * math.pi * f) * F.col(fit.options["x"])
        made += [F.sin(angle).alias(f"_s{i}"), F.cos(angle).alias(f"_c{i}")]
        names += [f"_s{i}", f"_c{i}"]
    return df.select("*", *made), names


@transform_of("harmonic")
def _harmonic(fit: Fitted, df: DataFrame) -> DataFrame:
    design, names = _design(fit, df)
    o = fit.options
    return design.withColumn(o["out"], linear_expression(names, o["weights"], o["intercept"])).drop(*names)


def align_domains(source: DataFrame, target: DataFrame, cols) -> DataFrame:
    """Center the target's features and whiten them by its covariance (+1e-6 I).

    Both tables give their means; only the target's covariance enters its own whitening.
    """
    require_numeric(source, cols)
    require_numeric(target, cols)
    m = moments(target, cols)[None]
    cov = m.cov * m.n / (m.n - 1) + 1e-6 * np.eye(len(cols))
    values, vectors = np.linalg.eigh(cov)
    root = vectors @ np.diag(1.0 / np.sqrt(values)) @ vectors.T
    new = {c: linear_expression(cols, root[:, j], -float(m.mean @ root[:, j])) for j, c in enumerate(cols)}
    return target.select(*[new[c].alias(c) if c in new else F.col(c) for c in target.columns])
