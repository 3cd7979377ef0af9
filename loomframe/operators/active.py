"""Active-learning selection: score a pool and take the n best (ties by id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.functions.arrays import doubles, entropy_of
from loomframe.functions.keys import hash_key
from loomframe.operators.neighbors import neighbors
from loomframe.plans.runtime import require_columns


def _take(scored: DataFrame, id_col: str, n: int, pool: DataFrame, ascending: bool = False) -> DataFrame:
    """Top-k without a global sort; 1 <= n <= pool size."""
    if n < 1:
        raise ValueError("n must be positive")
    if pool.limit(n).count() < n:
        raise ValueError("n is larger than the pool")
    order = F.col("score").asc() if ascending else F.col("score").desc()
    return scored.select(id_col, "score").orderBy(order, id_col).limit(n)


SCORES = {
    "uncertainty": lambda p: 1.0 - F.array_max(p),
    "entropy": entropy_of,
    "margin": lambda p: 1.0 - (F.sort_array(p, asc=False)[0] - F.sort_array(p, asc=False)[1]),
}


def query_probabilities(pool: DataFrame, id_col: str, probabilities: str, n: int, strategy: str = "uncertainty") -> DataFrame:
    """Most uncertain rows by their class probabilities (an array column)."""
    if strategy not in SCORES:
        raise ValueError(f"strategy must be one of {sorted(SCORES)}")
    require_columns(pool, [id_col, probabilities])
    scored = pool.select(id_col, SCORES[strategy](doubles(probabilities)).alias("score"))
    return _take(scored, id_col, n, pool)


def query_density(pool: DataFrame, id_col: str, cols, n: int, k: int = 5) -> DataFrame:
    """Rows in the densest places: 1 / (1 + mean distance to the k nearest others)."""
    near = neighbors(pool, pool, id_col, cols, k, exclude_self=True)
    scored = near.groupBy(F.col("query_id").alias(id_col)).agg((1.0 / (1.0 + F.avg("distance"))).alias("score"))
    return _take(scored, id_col, n, pool)


def query_committee(votes: DataFrame, id_col: str, n: int, model: str = "model", cls: str = "class", p: str = "p") -> DataFrame:
    """Rows on which the models disagree most: mean over classes of the population deviation over models."""
    per_class = votes.groupBy(id_col, cls).agg(F.stddev_pop(p).alias("s"))
    scored = per_class.groupBy(id_col).agg(F.avg("s").alias("score"))
    return _take(scored, id_col, n, scored)


def query_random(pool: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, in hash order."""
    if n < 1:
        raise ValueError("n must be positive")
    if pool.limit(n).count() < n:
        raise ValueError("n is larger than the pool")
    return pool.select(id_col).orderBy(hash_key(seed, id_col), id_col).limit(n)


def query_margin_decision(scored: DataFrame, id_col: str, decision: str, n: int) -> DataFrame:
    """Rows nearest to the decision boundary."""
    return _take(scored.select(id_col, F.abs(decision).alias("score")), id_col, n, scored, ascending=True)
