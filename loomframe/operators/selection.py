"""Ensembles of predictions, evaluation, cross-validation and parameter search."""

from __future__ import annotations

import itertools
import time

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.operators.linear import Fitted, linear_expression, moments, ridge_weights
from loomframe.operators.metrics import metric, metric_list
from loomframe.operators.split import kfold, stratified_kfold
from loomframe.plans.runtime import cut_lineage, require_columns


def _weighted(weights: dict | None, model: str):
    if weights is None:
        return F.lit(1.0)
    pairs = [v for k, w in weights.items() for v in (F.lit(k), F.lit(float(w)))]
    return F.element_at(F.create_map(*pairs), F.col(model))


def ensemble_average(votes: DataFrame, id_col: str, weights: dict | None = None, model: str = "model", pred: str = "pred") -> DataFrame:
    """(id, prediction): weighted mean of the models' predictions."""
    w = _weighted(weights, model)
    return votes.groupBy(id_col).agg((F.sum(w * F.col(pred)) / F.sum(w)).alias("prediction"))


def ensemble_soft_vote(votes: DataFrame, id_col: str, weights: dict | None = None, model: str = "model",
                       cls: str = "class", p: str = "p") -> DataFrame:
    """(id, prediction): class with the largest weighted mean probability, the smallest one on ties."""
    w = _weighted(weights, model)
    mean = votes.groupBy(id_col, cls).agg((F.sum(w * F.col(p)) / F.sum(w)).alias("_p"))
    best = F.min(F.struct((-F.round("_p", 12)).alias("p"), F.col(cls).alias("c")))
    return mean.groupBy(id_col).agg(best.alias("_b")).select(id_col, F.col("_b.c").alias("prediction"))


def evaluate(model, df: DataFrame, label: str, metrics, prediction: str = "prediction") -> DataFrame:
    """Score with model.transform and compute all metrics in one pass."""
    return metric_list(model.transform(df), label, prediction, metrics)


def _folded(df: DataFrame, id_col, label: str, k: int, strategy: str, seed: int) -> DataFrame:
    if strategy == "kfold":
        return kfold(df, id_col, k, seed=seed, out="_fold")
    if strategy == "stratified":
        return stratified_kfold(df, id_col, label, k, seed, out="_fold")
    raise ValueError("strategy must be 'kfold' or 'stratified'")


def cross_validate(fit, df: DataFrame, id_col, label: str, metrics, k: int = 5, strategy: str = "stratified",
                   seed: int = 42, prediction: str = "prediction") -> DataFrame:
    """(fold, metrics...) for fit(train) -> object with transform. Fold columns are written once and reused."""
    folded = cut_lineage(_folded(df, id_col, label, k, strategy, seed))
    out = None
    for i in range(k):
        model = fit(folded.filter(F.col("_fold") != i).drop("_fold"))
        scored = model.transform(folded.filter(F.col("_fold") == i))
        row = metric_list(scored, label, prediction, metrics).select(F.lit(i).alias("fold"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def cross_validate_ridge(df: DataFrame, cols, id_col, label: str, metrics=("mse", "mae", "r2"), k: int = 5,
                         alphas=(0.0,), strategy: str = "kfold", seed: int = 42) -> DataFrame:
    """(alpha, fold, metrics...) for least squares and ridge, for a whole grid in two passes.

    Pass one: moments per fold; a training set is the total minus its fold. Pass two: every fold is scored
    with its own weights for all alphas at once.
    """
    return _scored_ridge(*_fold_moments(df, cols, id_col, label, k, strategy, seed), cols, label, metrics, alphas)


def _fold_moments(df: DataFrame, cols, id_col, label: str, k: int, strategy: str, seed: int):
    """The table with its folds, and the moments of each fold and of all rows."""
    require_columns(df, [*cols, label])
    folded = _folded(df, id_col, label, k, strategy, seed)
    parts = moments(folded, [*cols, label], by="_fold")
    whole = None
    for m in parts.values():
        whole = m if whole is None else whole + m
    return folded, parts, whole


def _scored_ridge(folded: DataFrame, parts: dict, whole, cols, label: str, metrics, alphas) -> DataFrame:
    named = [metric(m) for m in metrics]
    aggs = []
    for j, alpha in enumerate(alphas):
        pred = None
        for fold, part in sorted(parts.items()):
            w, b = ridge_weights(whole - part, alpha)
            e = linear_expression(cols, w, b)
            pred = F.when(F.col("_fold") == fold, e) if pred is None else pred.when(F.col("_fold") == fold, e)
        aggs.append((f"_p{j}", pred))
    scored = folded.select("_fold", label, *[p.alias(n) for n, p in aggs])
    rows = scored.groupBy("_fold").agg(*[fn(F.col(label), F.col(f"_p{j}")).alias(f"{name}_{j}")
                                         for j in range(len(alphas)) for name, fn in named])
    packed = F.array(*[F.struct(F.lit(float(a)).alias("alpha"), F.col("_fold").alias("fold"),
                                *[F.col(f"{name}_{j}").alias(name) for name, _ in named]) for j, a in enumerate(alphas)])
    return rows.select(F.inline(packed))


def grid_search_ridge(df: DataFrame, cols, id_col, label: str, alphas, scoring: str = "r2", k: int = 5,
                      strategy: str = "kfold", seed: int = 42) -> tuple[DataFrame, Fitted]:
    """Scores (alpha, mean_score) and the best model refitted on all rows; the first alpha wins ties."""
    folded, parts, whole = _fold_moments(df, cols, id_col, label, k, strategy, seed)
    folds = _scored_ridge(folded, parts, whole, cols, label, [scoring], alphas)
    scores = folds.groupBy("alpha").agg(F.avg(scoring).alias("mean_score"))
    found = {r["alpha"]: r["mean_score"] for r in scores.collect()}
    best = max(alphas, key=lambda a: (found[float(a)], -list(alphas).index(a)))
    w, b = ridge_weights(whole, best)  # the folds' moments add up to those of all rows
    return df.sparkSession.createDataFrame([(float(a), found[float(a)]) for a in alphas], "alpha double, mean_score double"), \
        Fitted("linear", {"cols": list(cols), "weights": [float(v) for v in w], "intercept": float(b), "out": "prediction"})


def combinations(grid: dict) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def grid_search(make, grid: dict, df: DataFrame, id_col, label: str, scoring="accuracy", k: int = 5,
                strategy: str = "stratified", seed: int = 42):
    """All combinations with make(**params) -> fit function; returns (scores table, best params, refitted model)."""
    name, _ = metric(scoring)
    scores, best = [], None
    for params in combinations(grid):
        folds = cross_validate(make(**params), df, id_col, label, [scoring], k, strategy, seed)
        mean = folds.agg(F.avg(name)).first()[0]
        scores.append((str(params), mean))
        if best is None or mean > best[0]:
            best = (mean, params)
    table = df.sparkSession.createDataFrame(scores, "params string, mean_score double")
    return table, best[1], make(**best[1])(df)


def sample_params(space: dict, rng: np.random.Generator) -> dict:
    """One draw: a list is a choice, {'type': 'int' | 'float', 'min', 'max'} a range."""
    out = {}
    for name, dist in space.items():
        if isinstance(dist, (list, tuple)):
            out[name] = dist[int(rng.integers(len(dist)))]
        elif dist.get("type") == "int":
            out[name] = int(rng.integers(dist["min"], dist["max"]))
        elif dist.get("type") == "float":
            out[name] = float(rng.uniform(dist["min"], dist["max"]))
        else:
            raise ValueError(f"unknown distribution for {name}")
    return out


def random_search(models: dict, df: DataFrame, id_col, label: str, scoring="accuracy", n_trials: int = 10,
                  max_time: float | None = None, k: int = 5, seed: int = 42):
    """models: name -> (make, space). Returns (scores table, best model name, best params, refitted model).

    All trials are drawn first and then scored in order. With max_time (seconds) the trials not begun by then are in
    the table with a NULL score.
    """
    rng = np.random.default_rng(seed)
    metric_name, _ = metric(scoring)
    trials = [(name, i, sample_params(space, rng)) for name, (_, space) in models.items() for i in range(n_trials)]
    started, scores = time.time(), []
    for name, _, params in trials:
        late = max_time is not None and time.time() - started > max_time
        folds = None if late else cross_validate(models[name][0](**params), df, id_col, label, [scoring], k, "kfold", seed)
        scores.append(None if late else folds.agg(F.avg(metric_name)).first()[0])
    tried = [i for i, s in enumerate(scores) if s is not None]
    if not tried:
        raise ValueError("no model was trained")
    name, _, params = trials[max(tried, key=lambda i: scores[i])]
    rows = [(n, i, str(p), s) for (n, i, p), s in zip(trials, scores)]
    table = df.sparkSession.createDataFrame(rows, "model string, trial int, params string, mean_score double")
    return table, name, params, models[name][0](**params)(df)
