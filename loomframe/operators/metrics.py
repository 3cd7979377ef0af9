"""Metrics as aggregate expressions, impurities, curves and mutual information."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.arrays import EPSILON, doubles, softmax, total
from loomframe.plans.ordering import Ordered
from loomframe.plans.runtime import require_columns, settle


def _d(c: Column) -> Column:
    return c.cast("double")


def accuracy(y: Column, p: Column) -> Column:
    return F.avg((y == p).cast("double"))


def mse(y: Column, p: Column) -> Column:
    return F.avg((_d(y) - _d(p)) * (_d(y) - _d(p)))


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(_d(y) - _d(p)))


def r2(y: Column, p: Column) -> Column:
    """1 - residual / total sum of squares; 0 when the label is constant."""
    spread = F.var_pop(_d(y)) * F.count(_d(y))
    return F.when(spread > 0, 1.0 - F.try_divide(F.sum((_d(y) - _d(p)) * (_d(y) - _d(p))), spread)).otherwise(0.0)


METRICS: dict[str, Callable[[Column, Column], Column]] = {"accuracy": accuracy, "mse": mse, "mae": mae, "r2": r2}


def metric(m) -> tuple[str, Callable]:
    """Name and expression of a metric given by name or as a function (label, prediction) -> Column."""
    if callable(m):
        return getattr(m, "__name__", "metric"), m
    if m not in METRICS:
        raise ValueError(f"unknown metric {m!r}, expected one of {sorted(METRICS)} or a function")
    return m, METRICS[m]


def metric_list(df: DataFrame, label: str, prediction: str, metrics, by=()) -> DataFrame:
    """All metrics in one aggregation, one column each."""
    require_columns(df, [label, prediction, *by])
    named = [metric(m) for m in metrics]
    return df.groupBy(*by).agg(*[fn(F.col(label), F.col(prediction)).alias(name) for name, fn in named])


# impurities -------------------------------------------------------------------------------------------

def _entropy(p: Column) -> Column:
    return F.coalesce(F.sum(F.when(p > 0, -p * F.log2(p))), F.lit(0.0))


IMPURITIES = {
    "entropy": lambda p: _entropy(p),
    "gini": lambda p: 1.0 - F.sum(p * p),
    "misclassification": lambda p: 1.0 - F.max(p),
}


def impurity(df: DataFrame, label: str, kind: str = "entropy", by=()) -> DataFrame:
    """Impurity of a label column, per group if `by` is given. Labels are counted first, groups of any size."""
    if kind not in IMPURITIES:
        raise ValueError(f"impurity must be one of {sorted(IMPURITIES)}")
    counts = df.groupBy(*by, label).agg(F.count("*").alias("_n"))
    shares = counts.withColumn("_p", F.col("_n") / F.sum("_n").over(Window.partitionBy(*by)))
    return shares.groupBy(*by).agg(IMPURITIES[kind](F.col("_p")).alias(kind))


def information_gain(df: DataFrame, label: str, split: str, kind: str = "entropy") -> DataFrame:
    """One row: information_gain, split_entropy and gain_ratio of splitting by a column.

    One pass over the rows; everything else works on the (split, label) counts.
    """
    if kind not in IMPURITIES:
        raise ValueError(f"impurity must be one of {sorted(IMPURITIES)}")
    counts = settle(df.groupBy(F.col(split).alias("s"), F.col(label).alias("y")).agg(F.count("*").alias("n"))).df
    fn = IMPURITIES[kind]
    total_n = F.sum("n").over(Window.partitionBy())
    parent = (counts.groupBy("y").agg(F.sum("n").alias("n")).withColumn("p", F.col("n") / total_n)
              .agg(fn(F.col("p")).alias("parent")))
    child = (counts.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("s")))
             .groupBy("s").agg(fn(F.col("p")).alias("i"), F.sum("n").alias("n"))
             .withColumn("w", F.col("n") / total_n)
             .agg(F.sum(F.col("w") * F.col("i")).alias("child"), _entropy(F.col("w")).alias("split_entropy")))
    sides = child.first()  # two numbers
    gain = F.col("parent") - F.lit(sides["child"])
    ratio = gain / F.lit(sides["split_entropy"]) if sides["split_entropy"] else F.lit(0.0)
    return parent.select(gain.alias("information_gain"), F.lit(sides["split_entropy"]).alias("split_entropy"), ratio.alias("gain_ratio"))


# curves -----------------------------------------------------------------------------------------------

def _threshold_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score ascending: positives and negatives at or above it, and the totals; NULL labels are neither."""
    counts = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"),
        F.count("*").alias("n"))
    totals = df.agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg"),
                    F.count("*").alias("n_all")).first()
    ordered = Ordered(counts, [], [F.col("threshold")], F.col("threshold"), totals["n_all"], derived=True)
    run = ordered.running(reverse=True, tp=("sum", F.col("pos")), fp=("sum", F.col("neg")))
    return run.rows().withColumn("n_pos", F.lit(totals["n_pos"])).withColumn("n_neg", F.lit(totals["n_neg"]))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, tpr, fpr) at score >= threshold; a rate without denominator is NULL."""
    return _threshold_counts(df, label, score).select(
        "threshold", F.try_divide("tp", "n_pos").alias("tpr"), F.try_divide("fp", "n_neg").alias("fpr"))


def precision_recall_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, precision, recall) at score >= threshold."""
    called = F.col("tp") + F.col("fp")
    return _threshold_counts(df, label, score).select(
        "threshold", F.coalesce(F.try_divide(F.col("tp"), called), F.lit(1.0)).alias("precision"),
        F.try_divide("tp", "n_pos").alias("recall"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Binary area under the ROC curve by average ranks."""
    long = df.select(F.lit(1).alias("class"), F.col(label).alias("_y"), F.col(score).cast("double").alias("_s"))
    return _auc_per_class(long, df.count()).select(F.col("auc").alias("roc_auc"))


def roc_auc_ovr(df: DataFrame, label: str, scores: dict) -> DataFrame:
    """Macro mean of one-vs-rest areas; `scores` maps each class to its score column."""
    pairs = F.array(*[F.struct(F.lit(str(c)).alias("class"), (F.col(label).cast("string") == F.lit(str(c))).cast("int").alias("_y"),
                               F.col(s).cast("double").alias("_s")) for c, s in scores.items()])
    return _auc_per_class(df.select(F.inline(pairs)), df.count()).agg(F.avg("auc").alias("roc_auc"))


def _auc_per_class(long: DataFrame, n_rows: int) -> DataFrame:
    counts = long.groupBy("class", "_s").agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
    run = Ordered(counts, ["class"], [F.col("_s")], F.col("_s"), n_rows, derived=True).running(below=("sum", F.col("neg")))
    below = F.col("below") - F.col("neg")
    pairs = F.sum(F.col("pos").cast("double") * (below.cast("double") + F.col("neg") / 2.0))
    return run.rows().groupBy("class").agg(
        F.try_divide(pairs, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


# confusion --------------------------------------------------------------------------------------------

def confusion_matrix(df: DataFrame, label: str, prediction: str, normalize: bool = False) -> DataFrame:
    """(actual, predicted, n) over the grid of all classes; with normalize also the share of the row."""
    counts = settle(df.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted"))
                    .agg(F.count("*").alias("n"))).df
    classes = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).distinct()
    grid = (classes.agg(F.collect_set("c").alias("cs"))
            .select(F.explode("cs").alias("actual"), "cs").select("actual", F.explode("cs").alias("predicted")))
    out = grid.join(counts, ["actual", "predicted"], "left").fillna(0, ["n"])
    if normalize:
        row = F.sum("n").over(Window.partitionBy("actual"))
        out = out.withColumn("share", F.coalesce(F.try_divide(F.col("n"), row), F.lit(0.0)))
    return out


def weighted_scores(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Support-weighted precision, recall and f1; an empty denominator counts as 0."""
    counts = settle(df.groupBy(F.col(label).alias("a"), F.col(prediction).alias("p")).agg(F.count("*").alias("n"))).df
    sides = counts.select(F.inline(F.array(
        F.struct(F.col("a").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called"),
                 F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called"),
                 F.lit(0).cast("long").alias("hit")))))
    per = sides.groupBy("c").agg(F.sum("support").alias("s"), F.sum("called").alias("k"), F.sum("hit").alias("h"))
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    per = per.withColumn("precision", zero(F.try_divide("h", "k"))).withColumn("recall", zero(F.try_divide("h", "s")))
    per = per.withColumn("f1", zero(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))))
    return per.agg(*[(F.sum(F.col("s") * F.col(m)) / F.sum("s")).alias(f"weighted_{m}") for m in ("precision", "recall", "f1")])


# losses -----------------------------------------------------------------------------------------------

def cross_entropy(df: DataFrame, scores: str, label: str, from_logits: bool = True) -> DataFrame:
    """Mean of -ln(max(p[label], 1e-7)) with `scores` an array and `label` a class index."""
    p = softmax(doubles(scores)) if from_logits else doubles(scores)
    hit = F.element_at(p, F.col(label).cast("int") + 1)
    return df.agg(F.avg(-F.log(F.greatest(hit, F.lit(EPSILON)))).alias("cross_entropy"))


def quadratic_loss(df: DataFrame, prediction: str, target: str) -> DataFrame:
    """Half the mean over rows of the summed squared differences of two arrays."""
    diff = total(F.zip_with(doubles(prediction), doubles(target), lambda a, b: (a - b) * (a - b)))
    return df.agg((F.avg(diff) / 2.0).alias("quadratic_loss"))


def elastic_net_loss(df: DataFrame, label: str, prediction: str, weights, alpha: float = 1.0,
                     l1_ratio: float = 0.5) -> DataFrame:
    """Half the mse plus .01 alpha (r |w|_1 + (1 - r) |w|^2 / 2)."""
    w = [float(v) for v in weights]
    penalty = (0.01 * alpha * l1_ratio * sum(abs(v) for v in w)
               + 0.005 * alpha * (1 - l1_ratio) * sum(v * v for v in w))
    return df.agg((mse(F.col(label), F.col(prediction)) / 2.0 + F.lit(penalty)).alias("elastic_net_loss"))


# mutual information -----------------------------------------------------------------------------------

def mutual_information(df: DataFrame, cols, label: str, bins: int = 10) -> DataFrame:
    """(feature, mi): equal-width bins, log2; a constant column has 0."""
    require_columns(df, [*cols, label])
    limits = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols)
                      for n, f in (("lo", F.min), ("hi", F.max))]).first()
    binned = []
    for i, c in enumerate(cols):
        lo, hi = limits[f"lo{i}"], limits[f"hi{i}"]
        x = F.col(c).cast("double")
        b = F.lit(1) if lo is None or lo == hi else \
            F.least(F.floor((x - F.lit(lo)) / F.lit((hi - lo) / bins)), F.lit(bins - 1)).cast("int") + 1
        binned.append(F.struct(F.lit(c).alias("feature"), b.alias("b")))
    long = df.select(F.col(label).alias("y"), F.inline(F.array(*binned)))
    joint = settle(long.groupBy("feature", "b", "y").agg(F.count("*").alias("n"))).df
    f = Window.partitionBy("feature")
    n = F.sum("n").over(f)
    p_xy = F.col("n") / n
    p_x = F.sum("n").over(Window.partitionBy("feature", "b")) / n
    p_y = F.sum("n").over(Window.partitionBy("feature", "y")) / n
    terms = joint.select("feature", (p_xy * F.log2(p_xy / (p_x * p_y))).alias("t"))
    return terms.groupBy("feature").agg(F.sum("t").alias("mi"))


def select_top_features(df: DataFrame, cols, label: str, k: int, bins: int = 10) -> list[str]:
    """The k columns with the highest mutual information, in ascending order of it."""
    scores = mutual_information(df, cols, label, bins).collect()  # one row per column
    order = {c: i for i, c in enumerate(cols)}
    ranked = sorted(scores, key=lambda row: (row["mi"], order[row["feature"]]))
    return [row["feature"] for row in ranked[-k:]]
