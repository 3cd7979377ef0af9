"""Spectra of series: frames, transforms and harmonic regression."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomframe.operators.series import _names, positions
from loomframe.plans.runtime import CELL_ROWS, limit_of, null_safe_join, settle


def spectrogram(df: DataFrame, series, order, value: str, window: int, hop: int) -> DataFrame:
    """(series, frame, k, magnitude) of the one-sided transform of every complete frame.

    A frame holds exactly `window` rows, so groups are bounded however long a series is.
    """
    if window < 1 or hop < 1:
        raise ValueError("window and hop must be positive")
    series = _names(series)
    rows = positions(df, series, order).select(*series, "pos", F.col(value).cast("double").alias("v"))
    last = F.floor(F.col("pos") / hop)
    first = F.greatest(F.lit(0).cast("long"), F.ceil((F.col("pos") - (window - 1)) / hop))
    rows = rows.filter(first <= last).withColumn("frame", F.explode(F.sequence(first, last)))
    frames = (rows.groupBy(*series, "frame")
              .agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("_w"))
              .filter(F.size("_w") == window)
              .withColumn("_w", F.transform("_w", lambda s: s["v"])))

    @F.pandas_udf("array<double>")
    def magnitudes(frame: pd.Series) -> pd.Series:
        if len(frame) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(np.abs(np.fft.rfft(np.stack(frame.to_numpy()), axis=1))))

    return frames.select(*series, "frame", F.posexplode(magnitudes("_w")).alias("k", "magnitude"))


def spectral_centroid(df: DataFrame, series, order, value: str, window: int, hop: int, rate: float = 1.0) -> DataFrame:
    """Magnitude-weighted mean frequency, averaged over the frames of each series."""
    series = _names(series)
    s = spectrogram(df, series, order, value, window, hop)
    f = F.col("k") * F.lit(rate / window)
    per_frame = s.groupBy(*series, "frame").agg(
        F.coalesce(F.try_divide(F.sum(f * F.col("magnitude")), F.sum("magnitude")), F.lit(0.0)).alias("_c"))
    return per_frame.groupBy(*series).agg(F.avg("_c").alias("spectral_centroid"))


def _group_fft(df: DataFrame, series: list[str], group: str, index: str, inverse: bool = False) -> DataFrame:
    """Transform the complex values (re, im) of each (series, group) along `index`; groups are bounded."""
    packed = df.groupBy(*series, group).agg(F.sort_array(F.collect_list(F.struct(index, "re", "im"))).alias("_a"))
    packed = packed.select(*series, group, F.transform("_a", lambda s: s["re"]).alias("_re"),
                           F.transform("_a", lambda s: s["im"]).alias("_im"))
    sign = np.fft.ifft if inverse else np.fft.fft

    @F.pandas_udf("array<struct<re:double,im:double>>")
    def run(re: pd.Series, im: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(re, im):
            z = sign(np.asarray(a) + 1j * np.asarray(b)) * (len(a) if inverse else 1)
            out.append([{"re": x, "im": y} for x, y in zip(z.real, z.imag)])
        return pd.Series(out)

    return packed.select(*series, group, F.posexplode(run("_re", "_im")).alias("_q", "_z")).select(
        *series, group, F.col("_q").cast("long").alias("_q"), F.col("_z.re").alias("re"), F.col("_z.im").alias("im"))


def _four_step(df: DataFrame, series: list[str], rows_of: str, inverse: bool = False) -> DataFrame:
    """Transform of (series, j, re, im, n, n1) with n = n1 * n2: two passes over groups of n2 and n1 rows."""
    sign = 1.0 if inverse else -1.0
    keys = [*series, "n", "n1"]
    split = df.withColumn("_g", F.col("j") % F.col("n1")).withColumn("_i", F.floor(F.col("j") / F.col("n1")))
    first = _group_fft(split, keys, "_g", "_i", inverse)  # _q = k2
    angle = F.lit(sign * 2.0 * math.pi) * ((F.col("_g") * F.col("_q")) % F.col("n")) / F.col("n")
    c, s = F.cos(angle), F.sin(angle)
    turned = first.select(*keys, F.col("_q").alias("_k2"), F.col("_g").alias("_i1"),
                          (F.col("re") * c - F.col("im") * s).alias("re"), (F.col("re") * s + F.col("im") * c).alias("im"))
    second = _group_fft(turned, keys, "_k2", "_i1", inverse)  # _q = k1
    n2 = (F.col("n") / F.col("n1")).cast("long")
    return second.select(*keys, (F.col("_k2") + n2 * F.col("_q")).alias("j"), "re", "im")


def fourier_transform(df: DataFrame, series, order, value: str) -> DataFrame:
    """(series, k, re, im, n): the full discrete transform of every series, of any length.

    A series of at most cellRows rows is one group. A longer one of length n = n1 * n2 is done in two passes
    over groups of about sqrt(n) rows; a length without such factors is first turned into a cyclic
    convolution of power-of-two length (chirp transform).
    """
    series = _names(series)
    limit = limit_of(df.sparkSession, CELL_ROWS)
    rows = positions(df, series, order).select(*series, F.col("pos").alias("j"),
                                               F.col(value).cast("double").alias("re"), F.lit(0.0).alias("im"))
    sizes = df.groupBy(*series).agg(F.count("*").alias("n"))
    longest = sizes.agg(F.max("n")).first()[0] or 0
    if longest <= limit:
        out = _group_fft(null_safe_join(rows, settle(sizes).hinted(), series), [*series], "n", "j")
        return out.select(*series, F.col("_q").alias("k"), "re", "im", "n")

    # lengths above the limit are at most rows / cellRows; the short ones are told by the column alone
    lengths = [r["n"] for r in sizes.filter(F.col("n") > limit).select("n").distinct().collect()]
    factor = {n: _factor(n, limit) for n in lengths}
    plan = df.sparkSession.createDataFrame([(n, f or 0) for n, f in factor.items()], "n long, n1 long")
    parts = null_safe_join(sizes, plan, ["n"]).withColumn("n1", F.coalesce("n1", F.lit(-1)))
    rows = null_safe_join(rows, settle(parts).hinted(), series)
    outs = []
    if not sizes.filter(F.col("n") <= limit).isEmpty():
        short = _group_fft(rows.filter("n1 = -1"), series, "n", "j")
        outs.append(short.select(*series, F.col("_q").alias("k"), "re", "im", "n"))
    if any(f for f in factor.values()):
        whole = _four_step(rows.filter("n1 > 0"), series, "j")
        outs.append(whole.select(*series, F.col("j").alias("k"), "re", "im", "n"))
    if any(not f for f in factor.values()):
        outs.append(_chirp(rows.filter("n1 = 0").drop("n1"), series, limit))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def _factor(n: int, limit: int) -> int | None:
    """A divisor n1 of n with n1 and n / n1 both within the limit, as near to sqrt(n) as can be."""
    for n1 in range(math.isqrt(n), 0, -1):
        if n % n1 == 0:
            return n1 if n // n1 <= limit else None
    return None


def _chirp(rows: DataFrame, series: list[str], limit: int) -> DataFrame:
    """Bluestein: X_k = w_k * sum_j (x_j w_j) conj(w)_{k-j} with w_j = exp(-i pi j^2 / n)."""
    bits = F.ceil(F.log2(2.0 * F.col("n") - 1.0)).cast("int")
    power = lambda e: F.pow(F.lit(2.0), e.cast("double")).cast("long")
    m, n1 = power(bits), power(F.floor(bits / 2))

    def chirp(j, sign):
        # j^2 mod 2n keeps the angle exact
        angle = F.lit(sign * math.pi) * ((j * j) % (2 * F.col("n"))) / F.col("n")
        return F.cos(angle), F.sin(angle)

    base = rows.withColumn("_n", F.col("n")).withColumn("_m", m).withColumn("n1", n1)
    c, s = chirp(F.col("j"), -1.0)
    left = base.withColumn("re2", F.col("re") * c).withColumn("im2", F.col("re") * s)
    left = left.select(*series, "j", F.col("re2").alias("re"), F.col("im2").alias("im"), "_n", "_m", "n1")
    sizes = base.groupBy(*series, "_n", "_m", "n1").agg(F.count("*").alias("_c")).drop("_c")
    c, s = chirp(F.col("j"), 1.0)
    kernel = base.select(*series, "j", c.alias("re"), s.alias("im"), "_n", "_m", "n1")
    mirrored = kernel.filter("j > 0").withColumn("j", F.col("_m") - F.col("j"))

    def padded(part: DataFrame, start, stop) -> DataFrame:
        zeros = sizes.withColumn("j", F.explode(F.sequence(start, stop))).withColumn("re", F.lit(0.0)).withColumn("im", F.lit(0.0))
        return part.unionByName(zeros)

    a = padded(left, F.col("_n"), F.col("_m") - 1)
    b = kernel.unionByName(mirrored)
    b = padded(b, F.col("_n"), F.col("_m") - F.col("_n"))
    keys = [*series, "_n"]
    fa = _four_step(a.withColumnRenamed("_m", "n"), keys, "j")
    fb = _four_step(b.withColumnRenamed("_m", "n"), keys, "j")
    fb = fb.select(*keys, "j", F.col("re").alias("re_b"), F.col("im").alias("im_b"))
    both = fa.join(fb, [*keys, "j"]).select(
        *keys, "n", "n1", "j", (F.col("re") * F.col("re_b") - F.col("im") * F.col("im_b")).alias("re"),
        (F.col("re") * F.col("im_b") + F.col("im") * F.col("re_b")).alias("im"))
    back = _four_step(both, keys, "j", inverse=True).filter(F.col("j") < F.col("_n"))
    back = back.withColumn("_size", F.col("n")).withColumn("n", F.col("_n"))
    c, s = chirp(F.col("j"), -1.0)
    return back.select(*series, F.col("j").alias("k"), ((F.col("re") * c - F.col("im") * s) / F.col("_size")).alias("re"),
                       ((F.col("re") * s + F.col("im") * c) / F.col("_size")).alias("im"), "n")


def top_frequencies(df: DataFrame, series, order, value: str, n_components: int = 10) -> DataFrame:
    """(series, rank, frequency, magnitude): strongest frequencies in [0, 1/2], lower ones first on ties."""
    series = _names(series)
    spectrum = fourier_transform(df, series, order, value).filter(F.col("k") * 2 <= F.col("n"))
    magnitude = F.round(F.hypot("re", "im"), 9)
    spectrum = spectrum.select(*series, "k", (F.col("k") / F.col("n")).alias("frequency"), magnitude.alias("magnitude"))
    best = Window.partitionBy(*series).orderBy(F.desc("magnitude"), "k")
    return (spectrum.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n_components)
            .select(*series, "rank", "frequency", "magnitude"))


def fourier_features(df: DataFrame, series, order, value: str, n_components: int = 10) -> DataFrame:
    """Columns cos_i, sin_i of 2 pi f_i x for the strongest frequencies f_i of the row's series."""
    series = _names(series)
    top = top_frequencies(df, series, order, value, n_components)
    wide = top.groupBy(*series).agg(*[F.max(F.when(F.col("rank") == i + 1, F.col("frequency"))).alias(f"_f{i}")
                                      for i in range(n_components)])
    out = null_safe_join(df, settle(wide).hinted(), series)
    made = []
    for i in range(n_components):
        angle = F.lit(2.0 * math.pi) * F.col(f"_f{i}") * F.col(value)
        made += [F.cos(angle).alias(f"cos_{i}"), F.sin(angle).alias(f"sin_{i}")]
    return out.select(*df.columns, *made)
