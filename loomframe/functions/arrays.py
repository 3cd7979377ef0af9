"""Expressions on array<double> columns (higher-order functions, JVM side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: guard of gradients and logarithms.
EPSILON = 1e-7


def doubles(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def let(value: Column, body) -> Column:
    """Bind a value once: inside a lambda a repeated expression would be computed per element."""
    return F.transform(F.array(value), body).getItem(0)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def squared_distance(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(squared_distance(a, b))


def euclidean_gradient(a: Column, b: Column) -> Column:
    return let(euclidean(a, b) + EPSILON, lambda norm: F.zip_with(a, b, lambda x, y: (x - y) / norm))


def softmax(scores: Column) -> Column:
    exps = let(F.array_max(scores), lambda top: F.transform(scores, lambda s: F.exp(s - top)))
    return let(exps, lambda es: let(total(es), lambda t: F.transform(es, lambda e: e / t)))


def with_softmax(df: DataFrame, scores: list[Column], classes=None, out: str = "prediction",
                 probabilities: str = "probabilities") -> DataFrame:
    """Softmax of a known number of score columns as plain columns, which compile to one loop.

    Adds the probability array and the first most probable class (or its index without classes).
    """
    k = range(len(scores))
    base = df.columns
    staged = df.select(*base, *[s.alias(f"_z{i}") for i, s in enumerate(scores)])
    top = F.greatest(*[F.col(f"_z{i}") for i in k]) if len(scores) > 1 else F.col("_z0")
    staged = staged.select("*", top.alias("_top"))
    staged = staged.select(*base, "_top", *[f"_z{i}" for i in k], *[F.exp(F.col(f"_z{i}") - F.col("_top")).alias(f"_e{i}") for i in k])
    sum_e = F.col("_e0")
    for i in k[1:]:
        sum_e = sum_e + F.col(f"_e{i}")
    staged = staged.select("*", sum_e.alias("_sum"))
    first = F.lit(None)
    for i in reversed(k):
        value = F.lit(i if classes is None else classes[i])
        first = F.when(F.col(f"_z{i}") == F.col("_top"), value).otherwise(first)
    return staged.select(*base, F.array(*[F.col(f"_e{i}") / F.col("_sum") for i in k]).alias(probabilities), first.alias(out))


def argmax_class(p: Column) -> Column:
    """Zero-based index of the first maximum."""
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def row_normalize(a: Column, eps: float = 1e-12) -> Column:
    n = F.size(a)
    centered = let(total(a) / n, lambda mean: F.transform(a, lambda x: x - mean))
    return let(centered, lambda cs: let(F.sqrt(dot(cs, cs) / n + eps), lambda d: F.transform(cs, lambda c: c / d)))


def entropy_of(p: Column) -> Column:
    """Natural-log entropy of an array normalized to sum 1."""
    return let(total(p), lambda s: F.aggregate(
        p, F.lit(0.0), lambda acc, x: acc - F.when(x > 0, x / s * F.log(x / s)).otherwise(0.0)))
