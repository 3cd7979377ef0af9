"""Small frames with values worked out by hand, most of them at the edges."""

import math

import pytest
from pyspark.sql import functions as F

from loomframe.functions import scalar as S
from loomframe.operators import active, contract, encode, graph, metrics, missing, neighbors, outliers, scale, series, split, trees


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def column(df, c, order="id"):
    return [r[c] for r in df.orderBy(order).collect()]


def test_scalers_constant_column_and_empty_input(spark):
    df = frame(spark, [(1, 5.0, 1.0), (2, 5.0, 3.0)], "id int, k double, x double")
    assert column(scale.standard_scale(df, ["k", "x"]).transform(df), "k") == [0.0, 0.0]
    assert column(scale.standard_scale(df, ["x"]).transform(df), "x") == [-1.0, 1.0]
    assert column(scale.minmax_scale(df, ["k"], (2.0, 4.0)).transform(df), "k") == [2.0, 2.0]
    assert column(scale.robust_scale(df, ["k"]).transform(df), "k") == [0.0, 0.0]
    for fit in (scale.standard_scale, scale.minmax_scale, scale.robust_scale):
        with pytest.raises(ValueError):
            fit(df.limit(0), ["x"])
    with pytest.raises(ValueError):
        scale.standard_scale(df, ["nope"])


def test_scaling_keeps_nulls(spark):
    df = frame(spark, [(1, None), (2, 2.0), (3, 4.0)], "id int, x double")
    assert column(scale.standard_scale(df, ["x"]).transform(df), "x") == [None, -1.0, 1.0]
    assert column(scale.quantile_scale(df, ["x"], 3).transform(df), "x") == [None, 0.0, 1.0]


def test_quantile_scale_repeated_knots_take_the_highest(spark):
    df = frame(spark, [(i, v) for i, v in enumerate([1.0, 1.0, 1.0, 2.0, 3.0])], "id int, x double")
    assert column(scale.quantile_scale(df, ["x"], 5).transform(df), "x") == [0.5, 0.5, 0.5, 0.75, 1.0]


def test_unknown_categories(spark):
    train = frame(spark, [(1, "a", 1.0), (2, "b", 3.0)], "id int, c string, y double")
    test = frame(spark, [(1, "a", 0.0), (2, "z", 0.0), (3, None, 0.0)], "id int, c string, y double")
    assert column(encode.ordinal_encode(train, ["c"], unknown="ignore").transform(test), "c_ord") == [0, -1, -1]
    assert column(encode.frequency_encode(train, ["c"]).transform(test), "c_freq") == [0.5, 0.0, 0.0]
    assert column(encode.target_encode(train, ["c"], "y", 1.0).transform(test), "c_te") == [1.5, 2.0, 2.0]
    hot = encode.one_hot_encode(train, ["c"], "ignore").transform(test)
    assert column(hot, "c_a") == [1.0, 0.0, 0.0] and column(hot, "c_b") == [0.0, 0.0, 0.0]
    for fit in (encode.label_encode(train, ["c"]), encode.one_hot_encode(train, ["c"])):
        with pytest.raises(Exception, match="unknown category"):
            fit.transform(test).collect()
    with pytest.raises(ValueError, match="binary"):
        encode.woe_encode(train.withColumn("t", F.lit(1)), ["c"], "t")


def test_woe_value(spark):
    df = frame(spark, [(1, "a", 1), (2, "a", 0), (3, "a", 0), (4, "b", 1)], "id int, c string, y int")
    got = column(encode.woe_encode(df, ["c"], "y").transform(df), "c_woe")
    assert got[0] == pytest.approx(math.log((1 / 3 + 1e-7) / (2 / 3 + 1e-7)))


def test_impute_mode_tie_and_all_null(spark):
    df = frame(spark, [(1, 3, None), (2, 2, None), (3, None, None)], "id int, x int, z double")
    assert column(missing.impute(df, ["x"], "most_frequent").transform(df), "x") == [3, 2, 2]
    assert column(missing.impute(df, ["z"], "mean").transform(df), "z") == [None, None, None]
    with pytest.raises(ValueError):
        missing.impute(df, ["x"], "constant")


def test_knn_impute_leaves_rows_without_values(spark):
    df = frame(spark, [(1, 1.0, 10.0), (2, 2.0, 20.0), (3, 1.1, None), (4, None, None)], "id int, a double, b double")
    out = missing.knn_impute(df, "id", ["a", "b"], k=1)
    assert column(out, "b") == [10.0, 20.0, 10.0, None]


def test_interpolate_ends_and_gaps(spark):
    rows = [(1, i, v) for i, v in enumerate([None, 2.0, None, None, 8.0, None])] + [(2, 0, None)]
    df = frame(spark, rows, "s int, t int, v double")
    lin = [r["v"] for r in missing.interpolate(df, "s", "t", "v").filter("s = 1").orderBy("t").collect()]
    assert lin == [2.0, 2.0, 4.0, 6.0, 8.0, 8.0]
    fwd = [r["v"] for r in missing.interpolate(df, "s", "t", "v", "forward", 1).filter("s = 1").orderBy("t").collect()]
    assert fwd == [None, 2.0, 2.0, None, 8.0, 8.0]
    assert missing.interpolate(df, "s", "t", "v").filter("s = 2").first()["v"] is None


def test_seasonal_needs_two_periods(spark):
    df = frame(spark, [(1, i, float(i % 2)) for i in range(3)], "s int, t int, v double")
    out = series.seasonal_decompose(df, "s", "t", "v", 2).collect()
    assert all(r["trend"] is None and r["seasonal"] is None and r["residual"] is None for r in out)
    full = series.seasonal_decompose(frame(spark, [(1, i, float(i % 2)) for i in range(6)], "s int, t int, v double"), "s", "t", "v", 2)
    assert [r["seasonal"] for r in full.orderBy("t").collect()] == [-0.5, 0.5] * 3
    assert [r["trend"] for r in full.orderBy("t").collect()] == [None, 0.5, 0.5, 0.5, 0.5, None]


def test_lag_and_domain_errors(spark):
    df = frame(spark, [(1, 0, 5.0)], "s int, t int, v double")
    assert series.lag_features(df, "s", "t", "v", [1]).first()["lag_1"] == 0.0
    with pytest.raises(ValueError):
        series.lag_features(df, "s", "t", "v", [0])
    out = S.column_transforms(frame(spark, [(0.0, -4.0, 0.0)], "a double, b double, c double"), "log", ["a"])
    out = S.column_transforms(S.column_transforms(out, "sqrt", ["b"]), "reciprocal", ["c"]).first()
    assert (out["a"], out["b"], out["c"]) == (None, None, None)
    assert S.polynomial_terms(2, 2) == [(), (0,), (1,), (0, 0), (0, 1), (1, 1)]


def test_ratio_is_clamped(spark):
    out = frame(spark, [(1.0, 0.0), (0.0, 0.0), (1e300, 1e-300)], "a double, b double").select(
        S.safe_ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [r["r"] for r in out] == [1 / 2.220446049250313e-16, 0.0, 1.7976931348623157e308]


def test_split_sizes(spark):
    df = spark.range(10).withColumn("c", (F.col("id") == 0).cast("int"))
    assert split.train_test_split(df, "id", 0.25).filter("split = 'test'").count() == 3
    by_class = {(r["c"], r["split"]): r["count"] for r in split.train_test_split(df, "id", 0.25, stratify="c").groupBy("c", "split").count().collect()}
    assert by_class == {(0, "test"): 2, (0, "train"): 7, (1, "test"): 1}
    with pytest.raises(ValueError):
        split.train_test_split(df, "id", 1.0)
    sizes = sorted(r["count"] for r in split.kfold(df, "id", 4).groupBy("fold").count().collect())
    assert sizes == [2, 2, 3, 3]
    few = split.kfold(spark.range(3), "id", 5)
    assert sorted(r["fold"] for r in few.collect()) == [0, 1, 2]


def test_curves_with_one_class(spark):
    df = frame(spark, [(1, 0.3), (1, 0.7)], "y int, s double")
    assert [r["fpr"] for r in metrics.roc_curve(df, "y", "s").collect()] == [None, None]
    assert metrics.roc_auc(df, "y", "s").first()["roc_auc"] is None
    same = frame(spark, [(2.0, 2.0), (2.0, 1.0)], "y double, p double")
    assert metrics.metric_list(same, "y", "p", ["r2"]).first()["r2"] == 0.0
    with pytest.raises(ValueError):
        metrics.metric("nope")


def test_auc_ties(spark):
    df = frame(spark, [(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first()["roc_auc"] == pytest.approx(3.5 / 4)


def test_knn_ties_go_to_the_lower_id_and_label(spark):
    pts = frame(spark, [(1, [0.0], 7), (2, [0.0], 5), (3, [1.0], 5)], "id int, vec array<double>, y int")
    near = neighbors.neighbors(pts, pts, "id", "vec", 1, exclude_self=True)
    assert {r["query_id"]: r["point_id"] for r in near.collect()} == {1: 2, 2: 1, 3: 1}
    two = neighbors.knn_classify(frame(spark, [(9, [0.0])], "id int, vec array<double>"), pts, "id", "vec", "y", 2)
    assert two.first()["prediction"] == 5
    with pytest.raises(ValueError):
        neighbors.neighbors(pts, pts, "id", "vec", 3, exclude_self=True)


def test_lof_identical_points(spark):
    rows = [(i, [0.0, 0.0]) for i in range(6)] + [(9, [5.0, 5.0])]
    fit = outliers.LocalOutlierFactor("vec", 2, 0.1).fit(frame(spark, rows, "id int, vec array<double>"), "id")
    flags = {r["query_id"]: r["is_outlier"] for r in fit.result().collect()}
    assert flags[9] and not any(flags[i] for i in range(6))


def test_graph_small(spark):
    edges = frame(spark, [(0, 1, 2), (0, 2, 3), (0, 1, 3), (0, 3, 4)], "graph_id int, src int, dst int")
    nodes = frame(spark, [(0, i) for i in (1, 2, 3, 4, 5)] + [(1, 1)], "graph_id int, node int")
    clus = {r["graph_id"]: r["avg_clustering"] for r in graph.avg_clustering(edges, nodes).collect()}
    assert clus == {0: pytest.approx((1 + 1 + 1 / 3) / 5), 1: 0.0}
    betw = {r["graph_id"]: r["avg_betweenness"] for r in graph.avg_betweenness(edges, nodes).collect()}
    # node 3 lies between {1, 2} and 4: 2 of 6 pairs; mean over 5 nodes
    assert betw == {0: pytest.approx(2 / 6 / 5), 1: 0.0}
    deg = {r["graph_id"]: (r["avg_degree"], r["max_degree"]) for r in graph.degree_stats(edges, nodes).collect()}
    assert deg == {0: (8 / 5, 3), 1: (0.0, 0)}


def test_best_split_accepts_zero_gain(spark):
    df = frame(spark, [(1.0, 0), (1.0, 1), (2.0, 0), (2.0, 1)], "x double, y int")
    r = trees.best_split(df, ["x"], "y").first()
    assert (r["threshold"], r["gain"]) == (1.0, 0.0)
    flat = frame(spark, [(1.0, 0), (1.0, 1)], "x double, y int")
    assert trees.best_split(flat, ["x"], "y").count() == 0


def test_contract(spark):
    df = frame(spark, [("1", 1.0), ("x", float("nan")), (None, None)], "a string, b double")
    got = {r["column_name"]: (r["n_rows"], r["n_null"], r["n_nan"], r["n_uncastable"]) for r in contract.check_features(df, ["a", "b"]).collect()}
    assert got == {"a": (3, 1, 0, 1), "b": (3, 1, 1, 0)}
    with pytest.raises(ValueError):
        contract.require_numeric(df, ["a"])


def test_active_bounds(spark):
    pool = frame(spark, [(1, [0.5, 0.5]), (2, [0.9, 0.1])], "id int, p array<double>")
    assert active.query_probabilities(pool, "id", "p", 1).first()["id"] == 1
    for n in (0, 3):
        with pytest.raises(ValueError):
            active.query_probabilities(pool, "id", "p", n)


def test_betweenness_of_a_large_graph_by_joins(spark):
    """The search by joins, in several batches of sources, gives the value of the search in tasks."""
    ring = [(0, i, (i + 1) % 9) for i in range(9)] + [(0, 0, 4)]
    edges = frame(spark, ring, "graph_id int, src int, dst int")
    nodes = frame(spark, [(0, i) for i in range(9)], "graph_id int, node int")
    want = graph.avg_betweenness(edges, nodes).first()["avg_betweenness"]
    spark.conf.set("spark.loomframe.broadcastRows", "3")
    spark.conf.set("spark.loomframe.blockRows", "4")
    try:
        assert graph.avg_betweenness(edges, nodes).first()["avg_betweenness"] == pytest.approx(want)
    finally:
        spark.conf.unset("spark.loomframe.broadcastRows")
        spark.conf.unset("spark.loomframe.blockRows")
