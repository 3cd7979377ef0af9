"""Orders of any type on both plans, lengths of series, samples and split search at any scale of the target."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomframe.operators import encode, outliers, selection, split, text, topics, trees
from loomframe.operators.series import positions
from loomframe.operators.spectral import fourier_transform
from loomframe.plans.ordering import Ordered


@pytest.fixture
def cells(spark):
    spark.conf.set("spark.loomframe.cellRows", "100")
    yield
    spark.conf.unset("spark.loomframe.cellRows")


ORDERS = [("g", ["day", "event_id"]), ("event_type", ["day", "event_id"]), ("g", ["event_type", "event_id"]), ("user_id", ["ts", "event_id"]),
          ("g", ["ts", "event_id"]), ("g", ["name"])]


@pytest.mark.parametrize("series,order", ORDERS)
def test_positions_equal_one_window(spark, cells, sf, series, order):
    ev = spark.read.parquet(f"{sf}/events.parquet").withColumn("g", F.lit(1))
    ev = ev.withColumn("day", F.when(F.col("event_id") % 7 > 0, F.to_date("ts"))).withColumn("name", F.concat(F.lit("Customer#"), "event_id"))
    want = ev.select("event_id", (F.row_number().over(Window.partitionBy(series).orderBy(*order)) - 1).alias("pos"))
    got = positions(ev, series, order).select("event_id", "pos")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_texts_with_a_common_beginning_are_cut(spark, cells, sf):
    customers = spark.read.parquet("/root/testdata/sf0.01/customer.parquet")
    assert Ordered(customers, [], [F.col("c_name")], F.col("c_name")).df.select("_cell").distinct().count() >= 10
    names = sorted(r[0] for r in customers.select("c_name").collect())
    assert {(r["category"], r["code"]) for r in encode.sorted_codes(customers, "c_name").collect()} == {(n, i) for i, n in enumerate(names)}
    chunks = split.balanced_chunks(customers, "c_name", 7, "chunk").groupBy("chunk").agg(F.count("*").alias("n"), F.min("c_name"), F.max("c_name")).orderBy("chunk").collect()
    assert [r["n"] for r in chunks] == [215, 215] + [214] * 5 and all(a[3] < b[2] for a, b in zip(chunks, chunks[1:]))


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
def test_codes_of_days(spark, cells, sf, kind):
    days = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_shipdate").cast(kind).alias("d"))
    codes = encode.sorted_codes(days, "d").orderBy("category").collect()
    assert len(codes) > 100 and [r["code"] for r in codes] == list(range(len(codes)))


def test_small_groups_of_a_large_table_are_not_cut(spark, cells, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    assert not Ordered(events, ["user_id"], [F.col("ts")], F.col("ts")).split


def test_series_of_many_lengths_keep_their_transforms(spark):
    spark.conf.set("spark.loomframe.cellRows", "4")
    try:
        draw = np.random.default_rng(0)
        series = {n: draw.normal(size=n) for n in (5, 6, 7, 8, 2)}
        df = spark.createDataFrame([(n, j, float(x)) for n, xs in series.items() for j, x in enumerate(xs)], "s long, j long, x double")
        got = {(r["s"], r["k"]): complex(r["re"], r["im"]) for r in fourier_transform(df, "s", "j", "x").collect()}
    finally:
        spark.conf.unset("spark.loomframe.cellRows")
    want = {(n, k): z for n, xs in series.items() for k, z in enumerate(np.fft.fft(xs))}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("scale", [1e-8, 1.0, 1e8])
def test_split_search_does_not_depend_on_the_unit(spark, scale):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.pmod(F.xxhash64("id"), F.lit(100)) / 100.0).alias("a"),
                                  (F.when(F.col("id") <= 499, 1.0).otherwise(-1.0) * scale).alias("y"), F.lit(1.0).alias("h"))
    best = trees.best_split_regression(df, ["a", "x"], "y").first()
    assert (best["feature"], best["threshold"]) == ("x", 499.0)
    best = trees.best_split_second_order(df, ["a", "x"], "y", "h").first()
    assert (best["feature"], best["threshold"]) == ("x", 499.0)
    tree = trees.DecisionTreeRegressor(["a", "x"], "y", max_depth=2).fit(df)
    assert {round(r[0] / scale, 6) for r in tree.transform(df).select("prediction").distinct().collect()} == {1.0, -1.0}


@pytest.mark.parametrize("n", [100, 3000])
def test_every_tree_has_its_whole_sample(spark, n):
    forest = outliers.IsolationForest(["x"], n_trees=10, max_samples=256)
    slim = spark.range(n).select("id", F.array(F.col("id").cast("double")).alias("vec"))
    per_tree = min(256, n)
    bags = forest._bags(slim, n, per_tree)
    assert bags.groupBy("tree").count().filter(F.col("count") >= per_tree).count() == 10
    lowest = slim.crossJoin(spark.range(10).select(F.col("id").cast("int").alias("tree"))).withColumn(
        "h", F.xxhash64(F.lit(forest.seed), "tree", F.col("id").cast("string")))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("h", "id"))
    pick = lambda d: {(r["tree"], r["id"]) for r in d.withColumn("r", rank).filter(F.col("r") <= per_tree).collect()}
    assert pick(bags.select("tree", "id", "h")) == pick(lowest)


def test_topics_read_all_documents_and_words(spark):
    docs = spark.createDataFrame([(i, f"common word{i} other") for i in range(30)], "id long, t string")
    model = topics.TopicModel(k=2, max_iter=2).fit(docs, "t")
    assert model.vocabulary.df.count() == 32
    assert abs(sum(model.totals) - 90) < 1e-6  # every word of every document was counted in the last step


def test_search_reports_trials_left_out(spark):
    df = spark.range(60).select("id", F.col("id").cast("double").alias("x"), (F.col("id") % 2).alias("y"))

    def make(flip):
        return lambda train: type("M", (), {"transform": lambda self, d: d.withColumn("prediction", F.col("y") if not flip else 1 - F.col("y"))})()

    models = {"m": (make, {"flip": [0, 1]})}
    table, name, params, _ = selection.random_search(models, df, "id", "y", n_trials=3, k=2)
    assert table.count() == 3 and table.filter("mean_score IS NULL").count() == 0
    with pytest.raises(ValueError):
        selection.random_search(models, df, "id", "y", n_trials=3, k=2, max_time=-1.0)
