"""Splits, folds, samples and chunks.

Random order is the order of md5(seed | id). A split is a set of ranks in that order; the
hashes at these ranks are found from a histogram of hash prefixes, and rows are then
assigned by comparing their own hash with a few cutoffs. The rows themselves are never sorted
or shuffled, and a class of any size costs the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.keys import hash_key, poisson_one, uniform
from loomframe.plans.ordering import Ordered
from loomframe.plans.runtime import null_safe_join, require_columns, settle, widen

MAX_PREFIX_DIGITS = 5
PREFIX_ROWS = 2_000


def _prefix_digits(n_rows: int) -> int:
    """Hex digits that leave about PREFIX_ROWS rows per hash prefix (at most 16^5 prefixes)."""
    return max(0, min(MAX_PREFIX_DIGITS, round(math.log(max(n_rows, 1) / PREFIX_ROWS, 16))))


def _assign_by_rank(df: DataFrame, id_col, seed, keys, ranks, out: str, n_rows: int | None = None) -> DataFrame:
    """Add `out`: how many of the group's rank cutoffs lie before the row in hash order.

    ranks(total) gives the ascending one-based ranks as an array<bigint> column.
    """
    keys = list(keys)
    n = df.count() if n_rows is None else n_rows
    digits = _prefix_digits(n)
    hashed = df.withColumn("_h", hash_key(seed, id_col))
    narrow = widen(df.select(*{*keys, id_col}) if isinstance(id_col, str) else df, n).withColumn("_h", hash_key(seed, id_col))
    prefix = F.substring("_h", 1, digits) if digits else F.lit("")
    slim = narrow.select(*keys, "_h", prefix.alias("_p"))

    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    histogram = slim.groupBy(*keys, "_p").agg(F.count("*").alias("_n"))
    bounds = (
        histogram
        .withColumn("_upto", F.sum("_n").over(upto))
        .withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_rank", F.explode(ranks(F.col("_total"))))
        .filter((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_n")))
        .withColumn("_local", F.col("_rank") - (F.col("_upto") - F.col("_n")))
        .groupBy(*keys, "_p").agg(F.collect_list("_local").alias("_locals"))
    )
    bounds = settle(bounds).hinted()
    near = null_safe_join(slim, bounds, [*keys, "_p"], "inner")
    cutoffs = (
        near.withColumn("_local", F.row_number().over(Window.partitionBy(*keys, "_p").orderBy("_h")))
        .filter(F.array_contains("_locals", F.col("_local").cast("long")))
        .groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias("_cuts"))
    )
    cutoffs = settle(cutoffs)
    if not keys:
        row = cutoffs.df.first()
        before = sum(((F.col("_h") > F.lit(c)).cast("int") for c in (row["_cuts"] if row is not None else [])), F.lit(0))
        return hashed.withColumn(out, before).drop("_h")
    assigned = null_safe_join(hashed, cutoffs.hinted(), keys)
    before = F.size(F.filter(F.coalesce("_cuts", F.array().cast("array<string>")), lambda c: c < F.col("_h")))
    return assigned.withColumn(out, before.cast("int")).drop("_h", "_cuts")


def _ceil_share(total: Column, share: float) -> Column:
    return F.ceil(total * F.lit(float(share)))


def _check_share(n: int, share: float) -> None:
    if n == 0:
        raise ValueError("cannot split an empty table")
    if n - _ceil(n * share) <= 0:
        raise ValueError(f"a share of {share} leaves no training rows")


def _ceil(x: float) -> int:
    return int(-(-x // 1))


def train_test_split(df: DataFrame, id_col, test_size: float = 0.2, seed: int = 42,
                     stratify: str | None = None, out: str = "split") -> DataFrame:
    """Add a column 'train' / 'test' with exactly ceil(n * test_size) test rows.

    Stratified: max(1, floor(n_class * test_size)) test rows per class.
    """
    n = df.count()
    _check_share(n, test_size)
    keys = []
    if stratify is not None:
        require_columns(df, [stratify])
        if df.select(stratify).distinct().limit(2).count() >= 2:
            keys = [stratify]
    if keys:
        ranks = lambda t: F.array(F.greatest(F.lit(1), F.floor(t * F.lit(float(test_size)))).cast("long"))
    else:
        ranks = lambda t: F.array(_ceil_share(t, test_size).cast("long"))
    rows = _assign_by_rank(df, id_col, seed, keys, ranks, "_seg", n)
    return rows.withColumn(out, F.when(F.col("_seg") == 0, "test").otherwise("train")).drop("_seg")


def split3(df: DataFrame, id_col, test_size: float = 0.2, val_size: float = 0.2, seed: int = 42,
           out: str = "split") -> DataFrame:
    """Test rows first, then validation rows from the remainder, the rest is train."""
    n = df.count()
    _check_share(n, test_size)
    _check_share(n - _ceil(n * test_size), val_size)

    def ranks(t):
        test = _ceil_share(t, test_size)
        return F.array(test.cast("long"), (test + _ceil_share(t - test, val_size)).cast("long"))

    rows = _assign_by_rank(df, id_col, seed, [], ranks, "_seg", n)
    label = F.when(F.col("_seg") == 0, "test").when(F.col("_seg") == 1, "val").otherwise("train")
    return rows.withColumn(out, label).drop("_seg")


def _fold_ends(t: Column, k: int) -> Column:
    """Last rank of each of the first k-1 folds; the first n % k folds get one row more."""
    size, extra = F.floor(t / k), t % k
    ends = [((i + 1) * size + F.least(F.lit(i + 1), extra)).cast("long") for i in range(k - 1)]
    # a fold of size 0 has no last row; rank 0 matches nothing
    return F.array_distinct(F.filter(F.array(*ends), lambda e: (e >= 1) & (e < t)))


def kfold(df: DataFrame, id_col, k: int = 5, shuffle: bool = True, seed: int = 42, out: str = "fold") -> DataFrame:
    """Add the fold 0..k-1 of each row; sizes differ by at most one."""
    if k < 2:
        raise ValueError("k must be at least 2")
    if not shuffle:
        return balanced_chunks(df, id_col, k, out)
    return _assign_by_rank(df, id_col, seed, [], lambda t: _fold_ends(t, k), out)


def stratified_kfold(df: DataFrame, id_col, label: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Folds inside every class."""
    if k < 2:
        raise ValueError("k must be at least 2")
    require_columns(df, [label])
    return _assign_by_rank(df, id_col, seed, [label], lambda t: _fold_ends(t, k), out)


def subsample(df: DataFrame, id_col, frac: float, seed: int = 42) -> DataFrame:
    """int(n * frac) rows without replacement."""
    ranks = lambda t: F.array(F.floor(t * F.lit(float(frac))).cast("long"))
    n = df.count()
    if frac * n < 1:
        return df.limit(0)
    return _assign_by_rank(df, id_col, seed, [], ranks, "_seg", n).filter("_seg = 0").drop("_seg")


def sample_rows(df: DataFrame, id_col, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows without replacement."""
    return _assign_by_rank(df, id_col, seed, [], lambda t: F.array(F.lit(n).cast("long")), "_seg") \
        .filter("_seg = 0").drop("_seg")


def bootstrap(df: DataFrame, id_col, n_bags: int, seed: int = 42, replicate: bool = False) -> DataFrame:
    """Rows with a `bag` and a Poisson(1) `weight`; weight 0 is left out.

    With replicate, a row appears weight times instead of once.
    """
    bags = df.withColumn("bag", F.explode(F.sequence(F.lit(0), F.lit(n_bags - 1))))
    key = hash_key(seed, F.col("bag"), id_col)
    drawn = bags.withColumn("weight", poisson_one(uniform(key))).filter("weight > 0")
    if not replicate:
        return drawn
    return drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("weight")))).drop("copy", "weight")


def balanced_chunks(df: DataFrame, id_col: str, n_chunks: int, out: str = "chunk") -> DataFrame:
    """Contiguous chunks in id order; the first n % n_chunks chunks get one row more."""
    ordered = Ordered(df, [], [F.col(id_col)], F.col(id_col)).positions("_pos")
    n = ordered.n_rows
    size, extra = divmod(n, n_chunks)
    pos, head = F.col("_pos"), extra * (size + 1)
    tail = F.lit(extra) + F.floor((pos - head) / max(size, 1))
    chunk = F.when(pos < head, F.floor(pos / (size + 1))).otherwise(tail)
    return ordered.rows().withColumn(out, chunk.cast("int")).drop("_pos")
