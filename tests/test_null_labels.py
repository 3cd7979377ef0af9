"""Rows without a label or target take no part."""

import pytest

from loomframe.operators import encode, linear, metrics


def test_curves_leave_null_labels_out(spark):
    rows = [(1, 0.9), (0, 0.8), (None, 0.85), (1, 0.4), (0, 0.3), (None, 0.1)]
    df = spark.createDataFrame(rows, "y int, s double")
    curve = {r["threshold"]: (r["tpr"], r["fpr"]) for r in metrics.roc_curve(df, "y", "s").collect()}
    assert curve[0.3] == (1.0, 1.0) and curve[0.8] == (0.5, 0.5) and curve[0.1] == (1.0, 1.0)


@pytest.mark.parametrize("loss", ["softmax", "hinge"])
def test_a_null_label_is_no_class(spark, loss):
    rows = [(float(i), "a" if i < 10 else "b") for i in range(20)] + [(3.0, None)]
    df = spark.createDataFrame(rows, "x double, y string")
    fit = linear.gradient_fit(df, ["x"], "y", loss, "sgd", lr=0.01, max_iter=3)
    assert fit.classes == ["a", "b"]


def test_target_codes_without_a_target(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "c string, y double")
    out = encode.target_encode(df, ["c"], "y").transform(df).collect()
    assert [r["c_te"] for r in out] == [None, None]
