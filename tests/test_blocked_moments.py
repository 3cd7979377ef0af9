"""Moments of many columns: blocks merged on executors, one row per key and block for the driver."""

import numpy as np
import pytest

from loomframe.operators import linear


def frame(spark, n, p, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) @ rng.normal(size=(p, p)) + 1e6 * (np.arange(p) % 3 == 0)
    fold = np.arange(n) % 3
    cols = [f"x{i}" for i in range(p)]
    rows = [(int(f), *map(float, r)) for f, r in zip(fold, x)]
    return spark.createDataFrame(rows, "fold int, " + ", ".join(f"{c} double" for c in cols)), cols, x, fold


@pytest.mark.parametrize("block,rows", [(512, 1), (16, 6)])
def test_forty_columns_and_two_hundred_partitions(spark, monkeypatch, block, rows):
    monkeypatch.setattr(linear, "BLOCK", block)
    df, cols, x, fold = frame(spark, 1200, 40)
    seen = []
    original = type(df).toLocalIterator

    def counted(self, *a, **b):
        for row in original(self, *a, **b):
            seen.append(row)
            yield row

    monkeypatch.setattr(type(df), "toLocalIterator", counted)
    got = linear.moments(df.repartition(200), cols, by="fold")
    assert len(seen) == 3 * rows  # one row per key and block, not per partition
    for f, m in got.items():
        part = x[fold == f]
        assert m.n == len(part)
        np.testing.assert_allclose(m.mean, part.mean(axis=0), rtol=1e-12)
        want = np.cov(part, rowvar=False, bias=True)
        np.testing.assert_allclose(m.cov, want, rtol=1e-9, atol=1e-9 * np.abs(want).max())


def test_wide_regression(spark):
    df, cols, x, _ = frame(spark, 800, 30, seed=2)
    fit = linear.linear_fit(df.repartition(20), cols[:-1], cols[-1])
    a = np.column_stack([np.ones(len(x)), x[:, :-1]])
    want = np.linalg.lstsq(a - np.array([0, *x[:, :-1].mean(axis=0)]), x[:, -1], rcond=None)[0]
    np.testing.assert_allclose(fit.options["weights"], want[1:], rtol=1e-5, atol=1e-6)


def test_keys_with_nulls_and_empty_parts(spark):
    df, cols, _, _ = frame(spark, 90, 25, seed=3)
    df = df.selectExpr("nullif(fold, 2) AS fold", *cols)
    got = linear.moments(df.repartition(50), cols, by="fold")
    assert {k: m.n for k, m in got.items()} == {0: 30.0, 1: 30.0, None: 30.0}
    assert linear.moments(df.limit(0), cols) == {}
