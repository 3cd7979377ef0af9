"""Imputation by neighbours over the columns a row has: one search whatever the patterns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.operators import missing
from loomframe.operators.missing import knn_impute
from loomframe.plans import nearest


def plain(x, k, weights):
    out = x.copy()
    complete = np.flatnonzero(~np.isnan(x).any(axis=1))
    for i in range(len(x)):
        seen = ~np.isnan(x[i])
        if seen.all() or not seen.any():
            continue
        d = np.sqrt(((x[complete][:, seen] - x[i, seen]) ** 2).sum(axis=1))
        near = sorted(range(len(complete)), key=lambda j: (d[j], complete[j]))[:k]
        w = np.ones(k) if weights == "uniform" else 1 / (d[near] + np.finfo(float).eps)
        for j in np.flatnonzero(~seen):
            out[i, j] = (w * x[complete[near], j]).sum() / w.sum()
    return out


def frame(spark, x):
    cols = [f"v{j}" for j in range(x.shape[1])]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in cols)), cols


def holes(n, columns, seed=1, share=0.25):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, columns))
    x[rng.random((n, columns)) < share] = np.nan
    x[: n // 3] = np.round(rng.normal(size=(n // 3, columns)), 1)  # complete rows, with ties
    x[-1] = np.nan
    return x


@pytest.mark.parametrize("broadcast,block", [(100_000, 20_000), (150, 20_000), (10, 40)])
@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_every_plan_equals_numpy(spark, broadcast, block, weights):
    x = holes(600 if broadcast != 150 else 260, 6)
    df, cols = frame(spark, x)
    spark.conf.set("spark.loomframe.broadcastRows", str(broadcast))
    spark.conf.set("spark.loomframe.blockRows", str(block))
    try:
        got = np.array([[np.nan if r[c] is None else r[c] for c in cols] for r in knn_impute(df, "id", cols, 4, weights).orderBy("id").collect()])
    finally:
        spark.conf.unset("spark.loomframe.broadcastRows")
        spark.conf.unset("spark.loomframe.blockRows")
    np.testing.assert_allclose(got, plain(x, 4, weights), rtol=1e-9, atol=1e-12)


def test_many_patterns_take_one_search(spark, monkeypatch):
    """Twenty columns with about five hundred patterns of missing values."""
    x = holes(900, 20, seed=2)
    df, cols = frame(spark, x)
    assert len({tuple(np.isnan(r)) for r in x}) > 500
    searches = []
    join = missing.knn_join
    monkeypatch.setattr(missing, "knn_join", lambda *a, **b: searches.append(1) or join(*a, **b))
    got = np.array([[np.nan if r[c] is None else r[c] for c in cols] for r in knn_impute(df, "id", cols, 3).orderBy("id").collect()])
    assert len(searches) == 1
    np.testing.assert_allclose(got, plain(x, 3, "uniform"), rtol=1e-9, atol=1e-12)


def test_other_columns_and_types_stay(spark):
    df = spark.createDataFrame([(1, 1, None, "x"), (2, 1, 2.0, "y"), (3, 5, 7.0, None)], "id long, a int, b double, vec string")
    out = knn_impute(df, "id", ["a", "b"], 1).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1, 1.0, 2.0, "x"), (2, 1.0, 2.0, "y"), (3, 5.0, 7.0, None)]
    assert knn_impute(df.filter(F.col("b").isNotNull()), "id", ["a", "b"], 1).count() == 2
    with pytest.raises(ValueError):
        knn_impute(df.filter("id = 1"), "id", ["a", "b"], 1)


@pytest.mark.parametrize("broadcast", [100_000, 20])
def test_patterns_are_searched_over_distinct_values(spark, monkeypatch, broadcast):
    """Few values, repeated often: a search sees each of them once, results are those of all rows."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (800, 3)).astype(float)
    x[rng.random((800, 3)) < 0.2] = np.nan
    df, cols = frame(spark, x)
    sizes, plan = [], nearest._unlike
    monkeypatch.setattr(nearest, "MASKED_PAIRS", 0)
    monkeypatch.setattr(nearest, "_unlike", lambda q, p, k, own, n, m, *a, **b: sizes.append((n, m)) or plan(q, p, k, own, n, m, *a, **b))
    spark.conf.set("spark.loomframe.broadcastRows", str(broadcast))
    spark.conf.set("spark.loomframe.blockRows", "40")
    try:
        got = np.array([[np.nan if r[c] is None else r[c] for c in cols] for r in knn_impute(df, "id", cols, 4).orderBy("id").collect()])
    finally:
        spark.conf.unset("spark.loomframe.broadcastRows")
        spark.conf.unset("spark.loomframe.blockRows")
    np.testing.assert_allclose(got, plain(x, 4, "uniform"), rtol=1e-9, atol=1e-12)
    assert len(sizes) == 6 and all(n <= 36 and m <= 4 * 36 for n, m in sizes)
