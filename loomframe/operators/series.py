"""Window functions over series. A series of any length is cut into blocks with halo rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from loomframe.functions.keys import gaussian, hash_key, key_number, uniform
from loomframe.plans.ordering import Frames, Ordered
from loomframe.plans.runtime import null_safe_join, require_columns, settle

# Fixed value: guard of the rolling deviation.
STD_GUARD = 1e-7


def _names(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _lead(df: DataFrame, order: list[str], lead: Column | None) -> Column:
    if lead is not None:
        return lead
    kind = df.schema[order[0]].dataType.typeName()
    first = F.col(order[0])
    return F.unix_micros(first.cast("timestamp")) if kind.startswith("timestamp") else first


def _tie(df: DataFrame, order: list[str]) -> Column | None:
    """The second order column if it is a number."""
    return F.col(order[1]) if len(order) > 1 and isinstance(df.schema[order[1]].dataType, NumericType) else None


def frames(df: DataFrame, series, order, before: int = 0, after: int = 0, lead: Column | None = None) -> Frames:
    series, order = _names(series), _names(order)
    require_columns(df, [*series, *order])
    return Frames(df, series, [F.col(c) for c in order], _lead(df, order, lead), before, after, _tie(df, order))


def positions(df: DataFrame, series, order, lead: Column | None = None, name: str = "pos") -> DataFrame:
    """Zero-based position of every row in its series."""
    series, order = _names(series), _names(order)
    return Ordered(df, series, [F.col(c) for c in order], _lead(df, order, lead), tie=_tie(df, order)).positions(name).rows()


def rolling_zscore(df: DataFrame, series, order, value: str, window: int = 10, out: str = "zscore") -> DataFrame:
    """(x - mean) / (population std + 1e-7) over the row and the `window` rows before it."""
    f = frames(df, series, order, before=window)
    w = f.window.rowsBetween(-window, 0)
    x = F.col(value).cast("double")
    z = (x - F.avg(x).over(w)) / (F.stddev_pop(x).over(w) + STD_GUARD)
    return f.finish(f.df.withColumn(out, z)).drop("pos")


def lag_features(df: DataFrame, series, order, value: str, lags, prefix: str = "lag_") -> DataFrame:
    """One column per lag (sorted); missing history is 0.0."""
    lags = sorted(lags)
    if not lags or lags[0] < 1:
        raise ValueError("lags must be at least 1")
    f = frames(df, series, order, before=lags[-1])
    x = F.col(value).cast("double")
    return f.finish(f.df.select("*", *[F.lag(x, n, 0.0).over(f.window).alias(f"{prefix}{n}") for n in lags])).drop("pos")


def seasonal_decompose(df: DataFrame, series, order, value: str, period: int, model: str = "additive") -> DataFrame:
    """Columns trend, seasonal and residual; NULL in series shorter than two periods."""
    if model not in ("additive", "multiplicative"):
        raise ValueError("model must be additive or multiplicative")
    if period < 2:
        raise ValueError("period must be at least 2")
    series = _names(series)
    half, even = period // 2, period % 2 == 0
    f = frames(df, series, order, before=half, after=half)
    x = F.col(value).cast("double")
    outer = f.window.rowsBetween(-half, half)
    total = F.sum(x).over(outer)
    if even:  # weights 1/2, 1, ..., 1, 1/2
        total = total - (F.lag(x, half).over(f.window) + F.lead(x, half).over(f.window)) / 2
    trend = F.when(F.count(x).over(outer) == 2 * half + 1, total / period)
    ratio = model == "multiplicative"
    detrended = F.try_divide(x, F.col("trend")) if ratio else x - F.col("trend")
    rows = f.finish(f.df.withColumn("trend", trend)).withColumn("_d", detrended)

    phase = F.pmod(F.col("pos"), F.lit(period)).cast("int")
    figure = (rows.groupBy(*series, phase.alias("_phase"))
              .agg(F.avg("_d").alias("_fig"), F.count("*").alias("_n")))
    whole = Window.partitionBy(*series)
    center = F.avg("_fig").over(whole)
    seasonal = F.try_divide(F.col("_fig"), center) if ratio else F.col("_fig") - center
    figure = figure.select(*series, "_phase", seasonal.alias("_fig"), F.sum("_n").over(whole).alias("_len"))
    out = null_safe_join(rows.withColumn("_phase", phase), settle(figure).hinted(), [*series, "_phase"])
    enough = F.col("_len") >= 2 * period
    seasonal = F.when(enough, F.col("_fig"))
    trend = F.when(enough, F.col("trend"))
    residual = F.try_divide(x, trend * seasonal) if ratio else x - trend - seasonal
    return out.select(*df.columns, trend.alias("trend"), seasonal.alias("seasonal"), residual.alias("residual"))


# sequences in long form: (series, pos, value) --------------------------------------------------------

def pad_sequences(df: DataFrame, series, order, value: str, max_length: int | None = None,
                  padding: str = "post", fill: float = 0.0) -> DataFrame:
    """Every sequence as exactly max_length rows (series, pos, value); longer ones keep the first rows.

    The length defaults to the longest sequence. A sequence is never held in one row or task.
    """
    if padding not in ("post", "pre"):
        raise ValueError("padding must be 'post' or 'pre'")
    series = _names(series)
    rows = positions(df, series, order).select(*series, "pos", F.col(value).alias("value"))
    sizes = df.groupBy(*series).agg(F.count("*").alias("_len"))
    if max_length is None:
        max_length = sizes.agg(F.max("_len")).first()[0] or 0
    kept = F.least(F.col("_len"), F.lit(max_length))
    rows = rows.filter(F.col("pos") < max_length)
    missing = sizes.filter(F.col("_len") < max_length)
    if padding == "post":
        made = missing.select(*series, F.explode(F.sequence(F.col("_len"), F.lit(max_length - 1).cast("long"))).alias("pos"))
    else:
        made = missing.select(*series, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max_length - 1) - F.col("_len"))).alias("pos"))
        rows = null_safe_join(rows, settle(sizes).hinted(), series)
        rows = rows.withColumn("pos", F.col("pos") + F.lit(max_length) - kept).drop("_len")
    return rows.unionByName(made.withColumn("value", F.lit(fill).cast(df.schema[value].dataType)))


def augment_noise(df: DataFrame, series, order, value: str, sigma: float = 0.1, seed: int = 42,
                  out: str = "augmented") -> DataFrame:
    """Add normal noise; the draw depends on (seed, series, position) only."""
    rows = positions(df, series, order)
    key = hash_key(seed, F.lit("noise"), *_names(series), F.col("pos"))
    return rows.withColumn(out, F.col(value) + F.lit(float(sigma)) * gaussian(key))


def augment_warp(df: DataFrame, series, order, value: str, factor: float = 0.2, seed: int = 42,
                 out: str = "augmented") -> DataFrame:
    """Multiply every step by a uniform number in [1 - factor, 1 + factor)."""
    rows = positions(df, series, order)
    u = uniform(hash_key(seed, F.lit("warp"), *_names(series), F.col("pos")))
    return rows.withColumn(out, F.col(value) * (F.lit(1.0 - factor) + F.lit(2.0 * factor) * u))


def augment_crop(df: DataFrame, series, order, value: str, ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """A contiguous crop of int(length * (1 - ratio)) rows at a random start, renumbered from 0."""
    series = _names(series)
    rows = positions(df, series, order).select(*series, "pos", F.col(value).alias("value"))
    key = key_number(hash_key(seed, F.lit("crop"), *series))
    cuts = df.groupBy(*series).agg(F.count("*").alias("_len")).select(
        *series, F.floor(F.col("_len") * F.lit(1.0 - ratio)).alias("_crop"), "_len")
    cuts = cuts.select(*series, "_crop",
                       F.pmod(key, F.greatest(F.lit(1).cast("long"), F.col("_len") - F.col("_crop"))).alias("_start"))
    out = null_safe_join(rows, settle(cuts).hinted(), series)
    out = out.filter((F.col("pos") >= F.col("_start")) & (F.col("pos") < F.col("_start") + F.col("_crop")))
    return out.select(*series, (F.col("pos") - F.col("_start")).alias("pos"), "value")


def zero_crossing_rate(df: DataFrame, series, order, value: str, out: str = "zero_crossing_rate") -> DataFrame:
    """Share of samples whose sign differs from the sample before (the first one counts as unchanged)."""
    series = _names(series)
    f = frames(df, series, order, before=1)
    negative = F.col(value) < 0
    change = F.coalesce((negative != F.lag(negative).over(f.window)).cast("double"), F.lit(0.0))
    return f.finish(f.df.withColumn("_change", change)).groupBy(*series).agg(F.avg("_change").alias(out))
