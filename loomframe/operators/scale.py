"""Scalers: one aggregation to fit, a literal projection to transform."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.operators.contract import require_numeric
from loomframe.operators.fitted import Fitted, transform_of
from loomframe.plans.quantiles import quantiles

# Fixed value: distance of the outermost normal quantile knots from 0 and 1.
NORMAL_CLIP = 1e-7


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def _nonzero(x: float | None) -> float | None:
    return 1.0 if x == 0 else x


@transform_of("shift_scale")
def _shift_scale(fit: Fitted, df: DataFrame) -> DataFrame:
    """(x - shift) / scale * gain + low, per column."""
    gain, low = fit.options.get("gain", 1.0), fit.options.get("low", 0.0)
    new = {}
    for c, (shift, scale) in fit.options["columns"].items():
        x = F.col(c).cast("double")
        x = x if shift == 0 else x - F.lit(shift)
        x = x if scale == 1 else x / F.lit(scale)
        x = x if gain == 1 else x * F.lit(gain)
        new[c] = x if low == 0 else x + F.lit(low)
    return _replace(df, new)


def _checked(stats: dict[str, tuple], what: str) -> dict[str, tuple]:
    empty = [c for c, s in stats.items() if any(v is None for v in s)]
    if empty:
        raise ValueError(f"{what}: no values to fit in {empty}")
    return stats


def standard_scale(df: DataFrame, cols, with_mean: bool = True, with_std: bool = True) -> Fitted:
    """Mean and population standard deviation; a zero deviation counts as 1."""
    require_numeric(df, cols)
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols)
                   for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    stats = _checked({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}, "standard_scale")
    return Fitted("shift_scale", {"columns": {
        c: [m if with_mean else 0.0, _nonzero(s) if with_std else 1.0] for c, (m, s) in stats.items()}})


def minmax_scale(df: DataFrame, cols, feature_range=(0.0, 1.0)) -> Fitted:
    """Map [min, max] to the range; a constant column maps to its low end."""
    low, high = (float(v) for v in feature_range)
    if low >= high:
        raise ValueError("feature_range must be increasing")
    require_numeric(df, cols)
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(cols)
                   for n, f in (("lo", F.min), ("hi", F.max))]).first()
    stats = _checked({c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}, "minmax_scale")
    return Fitted("shift_scale", {
        "columns": {c: [lo, _nonzero(hi - lo)] for c, (lo, hi) in stats.items()},
        "gain": high - low, "low": low})


def robust_scale(df: DataFrame, cols, with_centering: bool = True, with_scaling: bool = True,
                 quantile_range=(25.0, 75.0), approximate: bool = False) -> Fitted:
    """Median and interquantile range."""
    require_numeric(df, cols)
    q = quantiles(df, cols, [0.5, quantile_range[0] / 100, quantile_range[1] / 100], approximate)
    stats = _checked({c: tuple(q[c]) for c in cols}, "robust_scale")
    return Fitted("shift_scale", {"columns": {
        c: [mid if with_centering else 0.0, _nonzero(hi - lo) if with_scaling else 1.0]
        for c, (mid, lo, hi) in stats.items()}})


def quantile_scale(df: DataFrame, cols, n_quantiles: int = 1000, output: str = "uniform",
                   approximate: bool = False) -> Fitted:
    """Piecewise-linear map of values to quantile ranks, or to normal scores."""
    if output not in ("uniform", "normal"):
        raise ValueError("output must be 'uniform' or 'normal'")
    require_numeric(df, cols)
    probs = [i / (n_quantiles - 1) for i in range(n_quantiles)]
    knots = quantiles(df, cols, probs, approximate)
    _checked({c: tuple(knots[c]) for c in cols}, "quantile_scale")
    refs = probs
    if output == "normal":
        refs = [NormalDist().inv_cdf(min(max(p, NORMAL_CLIP), 1 - NORMAL_CLIP)) for p in probs]
    return Fitted("knots", {"columns": {c: knots[c] for c in cols}, "refs": refs})


@transform_of("knots")
def _interpolate(fit: Fitted, df: DataFrame) -> DataFrame:
    """Interval lookup by binary search in the JVM, then a linear step; equal knots use the highest."""
    refs = fit.options["refs"]
    out, new = df, {}
    for i, (c, knots) in enumerate(fit.options["columns"].items()):
        last = {k: j for j, k in enumerate(knots)}  # highest index of each distinct knot
        xs = sorted(last)
        x = F.col(c).cast("double")
        if len(xs) == 1:
            new[c] = F.when(x < xs[0], F.lit(refs[0])).when(x.isNotNull(), F.lit(refs[-1]))
            continue
        starts = [refs[last[k]] for k in xs]
        slopes = [(refs[last[k] + 1] - refs[last[k]]) / (xs[j + 1] - k) for j, k in enumerate(xs[:-1])] + [0.0]
        splits = [float("-inf"), *xs, float("inf")]
        out = Bucketizer(splits=splits, inputCol=f"_x{i}", outputCol=f"_b{i}", handleInvalid="keep").transform(
            out.withColumn(f"_x{i}", x))
        at = F.col(f"_b{i}").cast("int")  # 0: below the first knot
        inside = (F.element_at(F.lit(starts), at)
                  + (x - F.element_at(F.lit(xs), at)) * F.element_at(F.lit(slopes), at))
        new[c] = F.when(x < xs[0], F.lit(refs[0])).when(x >= xs[-1], F.lit(refs[-1])).when(x.isNotNull(), inside)
    return _replace(out, new).select(*df.columns)
