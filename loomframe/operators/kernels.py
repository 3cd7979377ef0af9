"""Kernel rows of data against a table of landmarks (support vectors, prototypes).

The landmarks are broadcast when their counted size allows, so every data row is finished where it is read; a larger
landmark table is cut into blocks that each meet the data once. A row of the result is one kernel value.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.functions import arrays as A
from loomframe.plans.runtime import BROADCAST_ROWS, limit_of

BLOCK = 4_096


def _wavelet(x: Column, y: Column, a: float, c: float) -> Column:
    terms = F.zip_with(x, y, lambda u, v: F.cos((u - v) * a / c) * F.exp(-F.abs(u - v) / c))
    return F.aggregate(terms, F.lit(1.0), lambda s, t: s * t)


def _power(a: Column) -> Column:
    """Squared magnitudes of the full discrete Fourier transform of an array, a batch at a time."""

    @F.pandas_udf("array<double>")
    def run(rows: pd.Series) -> pd.Series:
        if len(rows) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(np.abs(np.fft.fft(np.stack(rows.to_numpy()), axis=1)) ** 2))

    return run(a)


def kernel(name: str | Callable, **params) -> Callable[[Column, Column], Column]:
    """A function of two array columns; a callable is taken as it is."""
    if callable(name):
        return name
    gamma, coef0, degree = params.get("gamma", 1.0), params.get("coef0", 0.0), params.get("degree", 3)
    table = {
        "linear": lambda x, y: A.dot(x, y),
        "rbf": lambda x, y: F.exp(A.squared_distance(x, y) * F.lit(-float(gamma))),
        "poly": lambda x, y: F.pow(A.dot(x, y) * F.lit(float(gamma)) + F.lit(float(coef0)), F.lit(float(degree))),
        "sigmoid": lambda x, y: F.tanh(A.dot(x, y) * F.lit(float(gamma)) + F.lit(float(coef0))),
        "rational_quadratic": lambda x, y: A.let(A.squared_distance(x, y), lambda d: 1.0 - d / (d + F.lit(float(params.get("alpha", 1.0))))),
        "wavelet": lambda x, y: _wavelet(x, y, float(params.get("a", 1.0)), float(params.get("c", 1.0))),
        "frequency_linear": lambda x, y: A.dot(x, y) * F.size(x),
        # one value per frequency
        "frequency_rbf": lambda x, y: F.transform(
            _power(F.zip_with(x, y, lambda u, v: u - v)), lambda m: F.exp(m * F.lit(-float(gamma)))),
    }
    if name not in table:
        raise ValueError(f"unknown kernel {name!r}, expected one of {sorted(table)}")
    return table[name]


def resolve_gamma(df: DataFrame, vec: str, gamma) -> float:
    """A number as given; 'auto' 1/p; 'scale' 1/(p * variance over all entries)."""
    if not isinstance(gamma, str):
        return float(gamma)
    if gamma not in ("auto", "scale"):
        raise ValueError("gamma must be a number, 'auto' or 'scale'")
    p = df.select(F.size(vec).alias("p")).first()["p"]
    if gamma == "auto":
        return 1.0 / p
    var = df.select(F.explode(A.doubles(vec)).alias("v")).agg(F.var_pop("v").alias("v")).first()["v"]
    return 1.0 / (p * var) if var else 1.0


def kernel_rows(df: DataFrame, landmarks: DataFrame, fn: Callable, id_col: str = "id", vec: str = "vec",
                landmark_id: str = "landmark_id", keep=()) -> DataFrame:
    """(id, landmark_id, *keep, k) for data (id, vec) and landmarks (landmark_id, vec, *keep)."""
    data = df.select(F.col(id_col), A.doubles(vec).alias("_x"))
    marks = landmarks.select(F.col(landmark_id), A.doubles(vec).alias("_y"), *keep)
    n = marks.count()
    if n == 0:
        raise ValueError("no landmarks")
    blocks = max(1, -(-n // min(BLOCK, limit_of(df.sparkSession, BROADCAST_ROWS))))
    block = F.pmod(F.xxhash64(landmark_id), F.lit(blocks)).cast("int")
    packed = marks.groupBy(block.alias("_b")).agg(F.collect_list(F.struct(landmark_id, "_y", *keep)).alias("_m"))
    # one packed row per block; a single block is small by its count and travels to the data
    packed = F.broadcast(packed) if blocks == 1 else packed
    joined = data.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(packed, "_b")
    out = joined.select(F.col(id_col), "_x", F.explode("_m").alias("_e"))
    return out.select(F.col(id_col), F.col(f"_e.{landmark_id}").alias(landmark_id),
                      *[F.col(f"_e.{c}").alias(c) for c in keep], fn(F.col("_x"), F.col("_e._y")).alias("k"))


def kernel_matrix(df: DataFrame, landmarks: DataFrame, name="rbf", id_col: str = "id", vec: str = "vec",
                  landmark_id: str = "landmark_id", gamma=1.0, **params) -> DataFrame:
    g = resolve_gamma(df, vec, gamma)
    return kernel_rows(df, landmarks, kernel(name, gamma=g, **params), id_col, vec, landmark_id)


def decision_function(df: DataFrame, support: DataFrame, name="rbf", bias: float = 0.0, id_col: str = "id",
                      vec: str = "vec", landmark_id: str = "landmark_id", gamma=1.0, **params) -> DataFrame:
    """(id, decision, prediction, probability) with support (landmark_id, vec, coef = alpha * y).

    The sum runs inside the row over the packed support vectors, so nothing is shuffled.
    """
    g = resolve_gamma(df, vec, gamma)
    fn = kernel(name, gamma=g, **params)
    n = support.count()
    if n <= min(BLOCK, limit_of(df.sparkSession, BROADCAST_ROWS)):
        packed = support.groupBy(F.pmod(F.xxhash64(landmark_id), F.lit(1)).cast("int").alias("_b")).agg(
            F.collect_list(F.struct(A.doubles(vec).alias("y"), F.col("coef").cast("double").alias("c"))).alias("_m"))
        joined = df.select(id_col, A.doubles(vec).alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(0))).alias("_b")).join(F.broadcast(packed), "_b")
        sums = joined.select(id_col, F.aggregate(
            "_m", F.lit(0.0), lambda s, m: s + m["c"] * fn(F.col("_x"), m["y"])).alias("_s"))
    else:
        rows = kernel_rows(df, support, fn, id_col, vec, landmark_id, keep=("coef",))
        sums = rows.groupBy(id_col).agg(F.sum(F.col("coef") * F.col("k")).alias("_s"))
    d = F.col("_s") + F.lit(float(bias))
    return sums.select(id_col, d.alias("decision"), F.signum(d).cast("int").alias("prediction"),
                       (1.0 / (1.0 + F.exp(-d))).alias("probability"))


def distance_scaling(df: DataFrame, id_col: str, vec: str, seed: int = 42) -> DataFrame:
    """(dims, mean_distance, std_distance): pair distances on the leading 1..p dimensions.

    Every row is paired with one other row: its successor in hash order, which is found by a sorted join
    on hash ranks, not by forming pairs.
    """
    from loomframe.functions.keys import hash_key, key_number
    from loomframe.plans.ordering import Ordered

    h = df.select(A.doubles(vec).alias("_v"), hash_key(seed, id_col).alias("_h"))
    ranked = Ordered(h, [], [F.col("_h")], key_number(F.col("_h"))).positions("_i")
    rows = ranked.rows().select("_i", "_v")
    nxt = rows.select((F.col("_i") - 1).alias("_i"), F.col("_v").alias("_w"))
    squares = rows.join(nxt, "_i").select(F.zip_with("_v", "_w", lambda a, b: (a - b) * (a - b)).alias("_d"))
    running = F.transform(F.col("_d"), lambda x, i: A.total(F.slice("_d", F.lit(1), i + 1)))
    long = squares.select(F.posexplode(running).alias("i", "s"))
    return long.groupBy((F.col("i") + 1).alias("dims")).agg(
        F.avg(F.sqrt("s")).alias("mean_distance"), F.stddev_pop(F.sqrt("s")).alias("std_distance"))
