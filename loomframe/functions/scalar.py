"""Projections and scalar transforms on named columns."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.plans.runtime import require_columns

# Spacing of doubles at 1.0, and the largest finite double.
FLOAT_EPS = 2.220446049250313e-16
MAX_DOUBLE = 1.7976931348623157e308


def as_double(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def polynomial_terms(n: int, degree: int, interaction_only: bool = False) -> list[tuple[int, ...]]:
    pick = combinations if interaction_only else combinations_with_replacement
    return [t for d in range(degree + 1) for t in pick(range(n), d)]


def polynomial_features(df: DataFrame, cols, degree: int = 2, interaction_only: bool = False,
                        prefix: str = "poly_", keep=()) -> DataFrame:
    """All monomials of total degree 0..degree (with the constant 1), as poly_0, poly_1, ..."""
    require_columns(df, cols)
    out = []
    for i, term in enumerate(polynomial_terms(len(cols), degree, interaction_only)):
        product = F.lit(1.0)
        for j in term:
            product = product * as_double(cols[j])
        out.append(product.alias(f"{prefix}{i}"))
    return df.select(*keep, *out)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b with zero denominators replaced by eps; infinities clamped, NaN to 0."""
    q = a / F.when(b == 0, F.lit(FLOAT_EPS)).otherwise(b)
    return (F.when(F.isnan(q), F.lit(0.0))
            .when(q > MAX_DOUBLE, F.lit(MAX_DOUBLE))
            .when(q < -MAX_DOUBLE, F.lit(-MAX_DOUBLE))
            .otherwise(q))


INTERACTIONS = {
    "multiply": lambda a, b: a * b,
    "add": lambda a, b: a + b,
    "subtract": lambda a, b: a - b,
    "divide": safe_ratio,
}


def interaction_features(df: DataFrame, cols, kind: str = "multiply", pairs=None) -> DataFrame:
    """The input columns plus one column per pair, named <a>_<kind>_<b>."""
    if kind not in INTERACTIONS:
        raise ValueError(f"interaction must be one of {sorted(INTERACTIONS)}")
    require_columns(df, cols)
    pairs = list(combinations(cols, 2)) if pairs is None else list(pairs)
    require_columns(df, [c for pair in pairs for c in pair])
    return df.select("*", *[INTERACTIONS[kind](as_double(a), as_double(b)).alias(f"{a}_{kind}_{b}")
                            for a, b in pairs])


# Values outside the domain of a transform give NULL.
TRANSFORMS = {
    "log": lambda x: F.when(x > 0, F.log(x)),
    "sqrt": lambda x: F.when(x >= 0, F.sqrt(x)),
    "square": lambda x: x * x,
    "abs": F.abs,
    "reciprocal": lambda x: F.try_divide(F.lit(1.0), x),
}


def column_transforms(df: DataFrame, transforms, cols) -> DataFrame:
    """Replace each column by a chain of transforms (names, or functions Column -> Column)."""
    require_columns(df, cols)
    chain = []
    for t in ([transforms] if isinstance(transforms, str) or callable(transforms) else list(transforms)):
        if not callable(t) and t not in TRANSFORMS:
            raise ValueError(f"unknown transform {t!r}")
        chain.append(t if callable(t) else TRANSFORMS[t])

    def apply(c: str) -> Column:
        x = as_double(c)
        for t in chain:
            x = t(x)
        return x.alias(c)

    return df.select(*[apply(c) if c in cols else F.col(c) for c in df.columns])


def relu(x: Column, alpha: float = 0.0) -> Column:
    return F.when(x > 0, x).otherwise(x * F.lit(float(alpha)))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def tanh(x: Column) -> Column:
    return F.tanh(x)


ACTIVATIONS = {"relu": relu, "sigmoid": sigmoid, "tanh": tanh, "linear": lambda x: x}


def signed_distances(dims: Column) -> tuple[Column, Column]:
    """The two signed distances -1/sqrt(d) and (d-1)/sqrt(d) of a d-dimensional simplex face."""
    root = F.sqrt(dims.cast("double"))
    return F.lit(-1.0) / root, (dims.cast("double") - 1.0) / root
