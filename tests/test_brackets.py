"""Quantiles of many columns in two scans, equal to the built-in percentile."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.plans import quantiles as plan
from loomframe.plans.quantiles import quantiles


@pytest.fixture
def small_cells(spark):
    spark.conf.set("spark.loomframe.cellRows", "200")
    yield
    spark.conf.unset("spark.loomframe.cellRows")


def wide(spark, n, columns):
    """Columns of other shapes: even, skewed, mostly one value, few values, constant, with nulls, all null."""
    u = [F.abs(F.xxhash64("id", F.lit(i)) % 1_000_003) / 1_000_003.0 for i in range(columns)]
    kinds = [lambda x: x, lambda x: F.exp(x * 20), lambda x: F.when(x < 0.7, 1.5).otherwise(x), lambda x: F.floor(x * 4).cast("double"),
             lambda x: F.lit(-2.0), lambda x: F.when(x < 0.3, None).otherwise(-x), lambda x: F.lit(None).cast("double")]
    return spark.range(n).select("id", *[kinds[i % len(kinds)](u[i]).alias(f"v{i}") for i in range(columns)])


def test_a_hundred_columns(spark, small_cells, monkeypatch):
    df = wide(spark, 5000, 100)
    df = spark.createDataFrame(df.toArrow())
    cols, probs = [f"v{i}" for i in range(100)], [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    scans = []
    whole = plan._by_brackets
    monkeypatch.setattr(plan, "_by_brackets", lambda *a: scans.append(len(a[0].columns)) or whole(*a))
    got = quantiles(df, cols, probs)
    assert scans == [100]  # one sketch and one count for all columns, no column was looked at again
    local = df.toPandas()
    for c in cols:
        v = local[c].dropna().to_numpy(dtype=float)
        if len(v):
            np.testing.assert_allclose(got[c], np.quantile(v, probs), rtol=1e-12)
        else:
            assert got[c] == [None] * len(probs)


def test_many_shares(spark, small_cells):
    df = wide(spark, 3000, 3)
    probs = np.linspace(0, 1, 301).tolist()
    local = df.toPandas()
    got = quantiles(df, ["v0", "v1", "v2"], probs)
    for c in got:
        np.testing.assert_allclose(got[c], np.quantile(local[c], probs), rtol=1e-12)


def test_a_sketch_that_is_off_is_widened(spark, small_cells):
    df = wide(spark, 3000, 2).select("v0", "v1")
    local = df.toPandas()
    got = plan._by_brackets(df, [0.3, 0.8], 3000, 1e-9)  # brackets of one value each
    for c in got:
        np.testing.assert_allclose(got[c], np.quantile(local[c], [0.3, 0.8]), rtol=1e-12)
