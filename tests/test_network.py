"""Back-propagation against finite differences, batches, partial sums and what a network learns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.operators import network
from loomframe.operators.network import NetworkClassifier, backward, forward, initial_layers


def loss(layers, x, y, slope=0.01):
    p = forward(layers, x, slope)[1]
    return -np.log(p[np.arange(len(y)), y]).sum()


def ring(spark, n=600, seed=1):
    """Class 1 inside a circle, class 0 outside: no linear rule tells them apart."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = ((x ** 2).sum(axis=1) < 1.2).astype(int)
    rows = [(i, float(a), float(b), "in" if c else "out") for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, y string"), x, y


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    layers = initial_layers([3, 5, 4, 3], 7)
    x, y = rng.normal(size=(20, 3)), rng.integers(0, 3, 20)
    gradient, told = backward(layers, x, y, 0.01)
    assert told[0] == pytest.approx(loss(layers, x, y)) and told[2] == 20
    for i, pair in enumerate(layers):
        for j, values in enumerate(pair):
            for at in np.ndindex(values.shape):
                step = 1e-6
                values[at] += step
                up = loss(layers, x, y)
                values[at] -= 2 * step
                down = loss(layers, x, y)
                values[at] += step
                assert gradient[i][j][at] == pytest.approx((up - down) / (2 * step), rel=1e-4, abs=1e-6)


def test_it_learns_a_ring(spark):
    df, _, _ = ring(spark)
    net = NetworkClassifier(["a", "b"], "y", [12], "id", batch_size=100, epochs=25, lr=0.05)
    net.fit(df.filter("id >= 150"), validation=df.filter("id < 150"))
    assert net.history[-1]["loss"] < net.history[0]["loss"] / 2
    assert net.history[-1]["validation_accuracy"] > 0.9
    out = net.transform(df.filter("id < 150")).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert out == pytest.approx(net.history[-1]["validation_accuracy"])


@pytest.mark.parametrize("method", ["adam", "momentum"])
def test_steps_equal_numpy(spark, method):
    """Two epochs of one batch against the same steps in plain NumPy, with penalties."""
    df, x, y = ring(spark, 200)
    net = NetworkClassifier(["a", "b"], "y", [3], "id", batch_size=10_000, epochs=2, method=method, lr=0.02, l1=0.001, l2=0.01).fit(df)
    layers = initial_layers([2, 3, 2], 42)
    memory = [[np.zeros_like(v), np.zeros_like(v)] for pair in layers for v in pair]
    label = 1 - y  # classes are sorted: in, out
    for t in (1, 2):
        gradient = backward(layers, x, label, 0.01)[0]
        for i, pair in enumerate(layers):
            for j, w in enumerate(pair):
                g = gradient[i][j] / len(y) + ((0.01 * w + 0.001 * np.sign(w)) if j == 0 else 0)
                m = memory[2 * i + j]
                if method == "adam":
                    m[0] = 0.9 * m[0] + 0.1 * g
                    m[1] = 0.999 * m[1] + 0.001 * g * g
                    w -= 0.02 * (m[0] / (1 - 0.9 ** t)) / (np.sqrt(m[1] / (1 - 0.999 ** t)) + 1e-8)
                else:
                    m[0] = 0.9 * m[0] - 0.02 * g
                    w += m[0]
    for (w, b), (v, c) in zip(net.layers, layers):
        np.testing.assert_allclose(w, v, rtol=1e-9)
        np.testing.assert_allclose(b, c, rtol=1e-9)


def test_sums_go_up_a_tree(spark, monkeypatch):
    """Many partitions give the same network as one, and a bounded number of rows reaches the driver."""
    df, _, _ = ring(spark, 300)
    one = NetworkClassifier(["a", "b"], "y", [3], "id", batch_size=100, epochs=1).fit(df.coalesce(1))
    monkeypatch.setattr(network, "FAN", 3)
    many = NetworkClassifier(["a", "b"], "y", [3], "id", batch_size=100, epochs=1).fit(df.repartition(20, "id"))
    for (w, b), (v, c) in zip(one.layers, many.layers):
        np.testing.assert_allclose(w, v, rtol=1e-8)
        np.testing.assert_allclose(b, c, rtol=1e-8)


def test_nulls_and_faults(spark):
    df, _, _ = ring(spark, 60)
    df = df.unionByName(spark.createDataFrame([(1000, None, 1.0, "in"), (1001, 1.0, 1.0, None)], df.schema))
    net = NetworkClassifier(["a", "b"], "y", [], "id", batch_size=16, epochs=2).fit(df)
    assert net.classes == ["in", "out"] and np.isfinite(net.history[-1]["loss"])
    rows = {r["id"]: r for r in net.transform(df).collect()}
    assert rows[1000]["prediction"] is None and rows[1001]["prediction"] in net.classes
    assert sum(rows[5]["probabilities"]) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        NetworkClassifier(["a", "b"], "y", [2], "id").fit(df.limit(0))
    with pytest.raises(ValueError):
        NetworkClassifier(["a"], "y", [2], "id", batch_size=0)


@pytest.mark.parametrize("method", ["adam", "sgd"])
def test_steps_in_one_task_equal_steps_by_jobs(spark, monkeypatch, method):
    """Batches that fit into cellRows many times are stepped through by a task per segment, with the same order and results."""
    df, _, _ = ring(spark, 500)
    made, chain = [], NetworkClassifier._chained
    monkeypatch.setattr(NetworkClassifier, "_chained", lambda self, *a: made.append(a[2]) or chain(self, *a))
    found, held = [], spark.conf.get("spark.loomframe.cellRows", None)
    try:
        for cell in (10, 130):
            spark.conf.set("spark.loomframe.cellRows", cell)
            found.append(NetworkClassifier(["a", "b"], "y", [4], "id", batch_size=40, epochs=3, method=method, lr=0.05, l1=0.001, l2=0.01).fit(df))
    finally:
        if held is None:
            spark.conf.unset("spark.loomframe.cellRows")
        else:
            spark.conf.set("spark.loomframe.cellRows", held)
    assert made == [3, 3, 3]
    for (w, b), (v, c) in zip(found[0].layers + found[0].gradient, found[1].layers + found[1].gradient):
        assert np.allclose(w, v, rtol=1e-9, atol=1e-12) and np.allclose(b, c, rtol=1e-9, atol=1e-12)
    for x, y in zip(found[0].history, found[1].history):
        assert x == pytest.approx(y)
