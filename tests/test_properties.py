"""Brute-force and property checks, for iterative and random operators above all."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.catalog.registry import table
from loomframe.operators import bayes, linear, neighbors, network, outliers, scale, selection, series, spectral, split, text, topics, trees, word_vectors
from loomframe.operators import encode
from loomframe.plans.ordering import Ordered
from loomframe.plans.quantiles import quantiles
from loomframe.streaming.transform import transform_stream


def limits(spark, **values):
    for k, v in values.items():
        spark.conf.set(f"spark.loomframe.{k}", str(v))


@pytest.fixture
def tuned(spark):
    def apply(**values):
        limits(spark, **values)
    yield apply
    for k in ("cellRows", "broadcastRows", "blockRows"):
        spark.conf.unset(f"spark.loomframe.{k}")


def blobs(spark, n=240, seed=1, hot=0.0):
    """Two separated classes; a share `hot` of all rows is one and the same point."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    x = rng.normal(size=(n, 3)) + 4.0 * y[:, None]
    h = int(n * hot)
    x[:h], y[:h] = x[0], y[0]
    rows = [(i, [float(v) for v in x[i]], int(y[i]), *[float(v) for v in x[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, vec array<double>, y int, a double, b double, c double"), x, y


@pytest.mark.parametrize("plan", ["points", "queries", "codes"])
@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_knn_plans_equal_brute_force(spark, tuned, plan, hot):
    df, x, _ = blobs(spark, hot=hot)
    queries = df
    keep = np.arange(len(x))
    if plan == "queries":
        queries, keep = df.filter("id < 30"), np.arange(30)
        tuned(broadcastRows=50)
    if plan == "codes":
        tuned(broadcastRows=10, blockRows=5)
    got = neighbors.neighbors(queries, df, "id", "vec", 4, exclude_self=True)
    found = {(r["query_id"], r["rank"]): (r["point_id"], r["distance"]) for r in got.collect()}
    assert len(found) == 4 * len(keep)
    for q in keep:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        order = sorted((dist, i) for i, dist in enumerate(d) if i != q)[:4]
        for rank, (dist, i) in enumerate(order, 1):
            assert found[(q, rank)][0] == i
            assert found[(q, rank)][1] == pytest.approx(dist, abs=1e-12)


@pytest.mark.parametrize("cells", [1_000_000, 37])
def test_quantiles_equal_numpy(spark, tuned, cells):
    tuned(cellRows=cells)
    rng = np.random.default_rng(3)
    v = np.concatenate([np.full(150, 2.5), rng.exponential(size=351)])  # one value holds a third of the rows
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    np.testing.assert_allclose(quantiles(df, ["v"], probs)["v"], np.quantile(v, probs), rtol=1e-12)


@pytest.mark.parametrize("lengths,cells", [([5, 16, 31], 1000), ([96, 101, 12], 40), ([64, 211], 40)])
def test_fourier_transform_equals_numpy(spark, tuned, lengths, cells):
    tuned(cellRows=cells)
    rng = np.random.default_rng(5)
    signals = {s: rng.normal(size=n) for s, n in enumerate(lengths)}
    df = spark.createDataFrame([(s, i, float(v)) for s, x in signals.items() for i, v in enumerate(x)], "s int, t int, v double")
    got = spectral.fourier_transform(df, "s", "t", "v").collect()
    for s, x in signals.items():
        mine = {r["k"]: complex(r["re"], r["im"]) for r in got if r["s"] == s}
        assert len(mine) == len(x)
        np.testing.assert_allclose([mine[k] for k in range(len(x))], np.fft.fft(x), atol=1e-8)


def test_windows_over_copies_of_one_time_stamp(spark, tuned):
    """A third of all rows are one series at one time stamp; ids decide their order."""
    rows = [(0, 5, i) for i in range(200)] + [(i % 7, i % 50, 1000 + i) for i in range(400)]
    df = spark.createDataFrame([(s, t, i, float(i * 7919 % 101)) for s, t, i in rows], "s int, t int, id long, v double")
    plain = series.rolling_zscore(df, "s", ["t", "id"], "v", 4).collect()
    tuned(cellRows=30)
    ordered = Ordered(df, ["s"], [F.col("t"), F.col("id")], F.col("t"), tie=F.col("id"))
    largest = ordered.df.groupBy("s", "_cell").count().agg(F.max("count")).first()[0]
    assert largest <= 60
    cut = series.rolling_zscore(df, "s", ["t", "id"], "v", 4).collect()
    a, b = ({r["id"]: r["zscore"] for r in x} for x in (plain, cut))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def brute_tree(x, y, depth, min_leaf=1):
    """Class tree by exhaustive gini search; returns predicted class shares of each row."""
    def gini(v):
        p = np.bincount(v, minlength=2) / len(v)
        return 1 - (p * p).sum()
    out = np.zeros((len(y), 2))

    def go(rows, d):
        share = np.bincount(y[rows], minlength=2) / len(rows)
        best = None
        if d < depth and len(rows) >= 2 and len(set(y[rows])) > 1:
            for f in range(x.shape[1]):
                for t in np.unique(x[rows, f]):
                    left = rows[x[rows, f] <= t]
                    right = rows[x[rows, f] > t]
                    if len(left) < min_leaf or len(right) < max(min_leaf, 1):
                        continue
                    g = round(gini(y[rows]) - len(left) / len(rows) * gini(y[left]) - len(right) / len(rows) * gini(y[right]), 12)
                    if best is None or (g, -f, -t) > best[0]:
                        best = ((g, -f, -t), left, right)
        if best is None:
            out[rows] = share
        else:
            go(best[1], d + 1)
            go(best[2], d + 1)
    go(np.arange(len(y)), 0)
    return out


@pytest.mark.parametrize("cells", [1_000_000, 30])
def test_decision_tree_equals_exhaustive_search(spark, tuned, cells):
    tuned(cellRows=cells)
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(120, 2)), 1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > -0.1) ^ (rng.random(120) < 0.1)).astype(int)
    df = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id int, a double, b double, y int")
    fit = trees.DecisionTreeClassifier(["a", "b"], "y", max_depth=3).fit(df)
    got = np.array([r["probabilities"] for r in fit.transform(df).orderBy("id").collect()])
    np.testing.assert_allclose(got, brute_tree(x, y, 3), atol=1e-12)
    table_ = fit.tree.table(spark)
    again = trees.tree_score(df, table_).orderBy("id").collect()
    np.testing.assert_allclose([r["value"] for r in again], got)


def test_wide_tree_is_routed_by_a_vectorized_walk(spark, monkeypatch):
    df, _, _ = blobs(spark, 100)
    fit = trees.DecisionTreeRegressor(["a", "b"], "c", max_depth=4).fit(df)
    nested = [r["prediction"] for r in fit.transform(df).orderBy("id").collect()]
    monkeypatch.setattr("loomframe.plans.levelwise.NESTED_LEAVES", 1)
    assert [r["prediction"] for r in fit.transform(df).orderBy("id").collect()] == nested


@pytest.mark.parametrize("method", ["squares", "second_order", "histogram"])
def test_boosting_reduces_the_error(spark, method):
    df, x, _ = blobs(spark, 150)
    errors = []
    for n in (1, 7):
        fit = trees.Boosting(["a", "b"], "c", n_trees=n, max_depth=2, learning_rate=0.3, method=method, bins=32).fit(df, "id")
        p = np.array([r["prediction"] for r in fit.transform(df).orderBy("id").collect()])
        errors.append(((x[:, 2] - p) ** 2).mean())
    assert errors[1] < errors[0] * 0.5


def test_forest_and_solvers_separate_the_classes(spark):
    df, _, y = blobs(spark)
    cols = ["a", "b", "c"]
    models = [
        trees.RandomForest(cols, "y", "id", n_trees=5, max_depth=3), linear.softmax_classifier(cols, "y", max_iter=20),
        linear.linear_svm(cols, "y", max_iter=20), network.NetworkClassifier(cols, "y", [4], "id", batch_size=60, epochs=30, lr=0.05),
    ]
    for model in models:
        hit = model.fit(df).transform(df).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
        assert hit > 0.95, model
    nb = bayes.gaussian_nb_fit(df, cols, "y").transform(df)
    assert nb.filter("prediction <> y").count() < 12
    lda = bayes.Discriminant(cols, "y", shrinkage=0.1).fit(df).predict(df)
    assert lda.filter("prediction <> y").count() < 12


@pytest.mark.parametrize("method", ["sgd", "adam", "momentum", "rmsprop", "adagrad", "adamax", "nadam"])
def test_optimizers_reduce_the_loss(spark, method):
    df, _, _ = blobs(spark)
    fit = linear.gradient_fit(df, ["a", "b"], "c", "elastic_net", method, lr=0.05, max_iter=150, tol=0.0)
    assert fit.history[-1] < fit.history[0] * 0.6


def test_moment_descent_equals_direct_descent(spark):
    df, x, _ = blobs(spark)
    fit = linear.gradient_fit(df, ["a", "b"], "c", "elastic_net", "sgd", lr=0.02, max_iter=20, tol=0.0, alpha=0.5, l1_ratio=0.3)
    w, b, target = np.zeros(2), 0.0, x[:, 2]
    for _ in range(20):
        e = target - x[:, :2] @ w - b
        g = -x[:, :2].T @ e / len(x) + 0.01 * 0.5 * (0.3 * np.sign(w) + 0.7 * w)
        w, b = w - 0.02 * g, b + 0.02 * e.mean()
    np.testing.assert_allclose(fit.weights[:, 0], w, rtol=1e-9)
    assert fit.intercept[0] == pytest.approx(b)


@pytest.mark.parametrize("loss", ["softmax", "hinge"])
def test_gradient_classifiers(spark, loss):
    df, _, y = blobs(spark)
    fit = linear.gradient_fit(df, ["a", "b", "c"], "y", loss, "adam", lr=0.2, max_iter=25)
    scored = fit.transform(df)
    want = F.when(F.col("y") == 1, 1).otherwise(-1) if loss == "hinge" else F.col("y")
    assert scored.filter(F.col("prediction") != want).count() < 15
    assert fit.history[-1] < fit.history[0]


def test_gram_of_many_columns_equals_builtin(spark, monkeypatch):
    df, _, _ = blobs(spark)
    a = linear.moments(df, ["a", "b", "c"], by="y")
    monkeypatch.setattr(linear, "BUILTIN_MOMENTS", 1)
    b = linear.moments(df, ["a", "b", "c"], by="y")
    for k in a:
        assert a[k].n == b[k].n
        np.testing.assert_allclose(a[k].cov, b[k].cov, rtol=1e-9)
    both = a[0] + a[1]
    np.testing.assert_allclose((both - a[0]).cov, a[1].cov, rtol=1e-9)


def test_discriminant_matches_numpy(spark):
    df, x, y = blobs(spark)
    fit = bayes.Discriminant(["a", "b", "c"], "y").fit(df)
    within = sum(((x[y == c] - x[y == c].mean(0)).T @ (x[y == c] - x[y == c].mean(0))) for c in (0, 1))
    np.testing.assert_allclose(fit.within, within, rtol=1e-9)
    v = fit.scalings[:, 0]
    ratio = (fit.between @ v) / (within @ v)
    np.testing.assert_allclose(ratio, ratio[0], rtol=1e-6)


def test_whitening(spark):
    df, _, _ = blobs(spark)
    out = linear.align_domains(df, df, ["a", "b", "c"])
    m = linear.moments(out, ["a", "b", "c"])[None]
    np.testing.assert_allclose(m.mean, 0, atol=1e-9)
    np.testing.assert_allclose(m.cov * m.n / (m.n - 1), np.eye(3), atol=1e-4)


def test_elastic_net_shrinks(spark):
    df, _, _ = blobs(spark)
    plain = linear.linear_fit(df, ["a", "b"], "c").options["weights"]
    lasso = linear.linear_fit(df, ["a", "b"], "c", alpha=100.0, l1_ratio=1.0).options["weights"]
    assert np.abs(lasso).sum() < np.abs(plain).sum()


def test_isolation_forest_finds_planted_points(spark):
    rng = np.random.default_rng(0)
    rows = [(i, *map(float, rng.normal(size=2))) for i in range(400)] + [(400 + i, 9.0 + i, -9.0) for i in range(4)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    forest = outliers.IsolationForest(["a", "b"], 40, 64, 0.02).fit(df, "id")
    first = [r["id"] for r in forest.score(df).orderBy("path_length").limit(4).collect()]
    assert set(first) == {400, 401, 402, 403}
    again = outliers.IsolationForest(["a", "b"], 40, 64, 0.02).fit(df.repartition(5), "id")
    assert again.threshold == forest.threshold


def test_condensed_prototypes_classify_all_rows(spark):
    df, x, y = blobs(spark, 80)
    kept = {r["id"] for r in neighbors.condensed_selection(df, "id", "vec", "y").collect()}
    ids = np.array(sorted(kept))
    for i in range(len(x)):
        d = np.sqrt(((x[ids] - x[i]) ** 2).sum(axis=1))
        assert y[ids[np.argmin(d)]] == y[i]
    assert len(kept) < 40


def test_locally_weighted_blocks_equal_broadcast(spark, tuned):
    df, x, _ = blobs(spark, 90)
    a = {r["query_id"]: r["prediction"] for r in neighbors.locally_weighted_regress(df, df, "id", ["a", "b"], "c", "gaussian", 2.0).collect()}
    tuned(broadcastRows=10, blockRows=20)
    b = {r["query_id"]: r["prediction"] for r in neighbors.locally_weighted_regress(df, df, "id", ["a", "b"], "c", "gaussian", 2.0).collect()}
    for q in range(90):
        w = np.exp(-((x[:, :2] - x[q, :2]) ** 2).sum(1) / 8.0)
        beta = np.linalg.solve((x[:, :2] * w[:, None]).T @ x[:, :2], (x[:, :2] * w[:, None]).T @ x[:, 2])
        assert a[q] == pytest.approx(x[q, :2] @ beta, rel=1e-9)
        assert b[q] == pytest.approx(a[q], rel=1e-9)


def test_random_draws_do_not_depend_on_partitions(spark):
    df = spark.range(500)
    one = {r["id"] for r in split.subsample(df.coalesce(1), "id", 0.3).collect()}
    many = {r["id"] for r in split.subsample(df.repartition(7), "id", 0.3).collect()}
    assert one == many and len(one) == 150
    w = {r["weight"] for r in split.bootstrap(df, "id", 1, replicate=False).collect()}
    mean = split.bootstrap(df, "id", 20).agg(F.sum("weight")).first()[0] / (20 * 500)
    assert min(w) >= 1 and abs(mean - 1.0) < 0.05
    assert split.bootstrap(df, "id", 3, replicate=True).count() == split.bootstrap(df, "id", 3).agg(F.sum("weight")).first()[0]


def test_text_models(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    v = word_vectors.word2vec_document_vectors(docs, "doc_id", "text", size=8, min_count=3)
    assert v.count() == docs.count() and v.filter(F.size("vec") != 8).count() == 0
    model = topics.TopicModel(k=3, max_iter=3).fit(docs, "text")
    shares = model.transform(docs, "text").select(F.aggregate("topics", F.lit(0.0), lambda s, x: s + x).alias("s"))
    assert shares.filter((F.abs(F.col("s") - 1) > 1e-6) & (F.col("s") != 0)).count() == 0  # 0: no known word
    assert model.log_likelihood(docs, "text") < 0
    assert model.topics(4).count() == 12


def test_search(spark):
    df, _, _ = blobs(spark, 120)
    make = lambda reg: (lambda train: linear.linear_svm(["a", "b", "c"], "y", reg, 5).fit(train))
    scores, best, model = selection.grid_search(make, {"reg": [0.01, 1.0]}, df, "id", "y", "accuracy", 3)
    assert scores.count() == 2 and best["reg"] in (0.01, 1.0)
    assert model.transform(df).filter("prediction <> y").count() < 12
    with pytest.raises(ValueError):
        selection.cross_validate(make(0.1), df, "id", "y", ["accuracy"], 3, "other")


def test_fitted_transforms_run_on_a_stream(spark, sf, tmp_path):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    source = tmp_path / "in"
    orders.repartition(3).write.parquet(str(source))
    stream = spark.readStream.schema(orders.schema).parquet(str(source))
    scaled = scale.standard_scale(orders, ["o_totalprice"])
    coded = encode.frequency_encode(orders, ["o_orderpriority"])
    for i, fit in enumerate((scaled, coded)):
        out = tmp_path / f"out{i}"
        q = transform_stream(fit, stream, str(out), str(tmp_path / f"ck{i}"))
        assert q.awaitTermination(120)
        got = spark.read.parquet(str(out)).orderBy("o_orderkey").collect()
        assert got == fit.transform(orders).orderBy("o_orderkey").collect()


def test_condensed_rounds_are_guessed_and_checked(spark, monkeypatch):
    """Few passes settle many rounds, whatever the guess begins with; the choice is that of a plain loop."""
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(600, 2)), 1)
    y = (x[:, 0] + 0.4 * np.sin(5 * x[:, 1]) > 0).astype(int) + (x[:, 1] > 1)
    chosen, newest = [], [int(np.flatnonzero(y == c)[0]) for c in np.unique(y)]
    n_rounds = 0
    while newest:
        chosen, n_rounds = sorted(chosen + newest), n_rounds + 1
        near = np.array(chosen)[np.sqrt(((x[:, None] - x[chosen][None]) ** 2).sum(axis=2)).argmin(axis=1)]
        missed = np.flatnonzero(y[near] != y)
        newest = [int(missed[y[missed] == c][0]) for c in np.unique(y[missed])]
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))], "id long, vec array<double>, y int")
    passes, cut = [], neighbors.cut_lineage
    monkeypatch.setattr(neighbors, "cut_lineage", lambda d: passes.append(1) or cut(d))
    for working in (2_000, 20):
        monkeypatch.setattr(neighbors, "WORKING", working)
        passes.clear()
        assert sorted(r["id"] for r in neighbors.condensed_selection(df, "id", "vec", "y").collect()) == chosen
        assert len(passes) < (n_rounds / 2 if working == 2_000 else n_rounds)
