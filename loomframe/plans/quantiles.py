"""Exact quantiles of many columns at once.

A first scan takes one mergeable sketch per column. Its rank error is bounded, so the values of a little smaller and a little
larger share bracket each wanted rank. A second scan counts, for all columns, how many values lie below each bracket and how
often each value inside occurs; the value of the rank is read off. Brackets are narrow enough for one task to order
their distinct values, and a value that occurs very often is one row of counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomframe.plans.runtime import CELL_ROWS, cut_lineage, limit_of

COUNTS = pa.schema([("c", pa.int32()), ("b", pa.int32()), ("v", pa.float64()), ("n", pa.int64())])


def quantiles(df: DataFrame, cols, probs, approximate: bool = False, accuracy: int = 10_000,
              n_rows: int | None = None) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles of each column (nulls skipped).

    A table of at most cellRows rows uses the built-in `percentile`. Beyond that a value count map
    would not fit one task, so only brackets of the wanted ranks are looked at closely, where NaN counts as infinity.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    if approximate:
        row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(f"q{i}")
                       for i, c in enumerate(cols)]).first()
        return {c: list(row[f"q{i}"] or [None] * len(probs)) for i, c in enumerate(cols)}
    n = df.count() if n_rows is None else n_rows
    if n <= limit_of(df.sparkSession, CELL_ROWS):
        # percentile with one value per call keeps results identical to np.percentile
        row = df.agg(*[F.percentile(F.col(c).cast("double"), F.array(*[F.lit(p) for p in probs])).alias(f"q{i}")
                       for i, c in enumerate(cols)]).first()
        return {c: list(row[f"q{i}"] or [None] * len(probs)) for i, c in enumerate(cols)}
    return _by_brackets(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), probs, n)


def _brackets(sketch: list[float] | None, probs: list[float], slack: float) -> np.ndarray:
    """Disjoint (low, high) that hold the wanted ranks, from the sketched values at each share less and plus the slack."""
    out: list[list[float]] = []
    value = lambda v: np.inf if np.isnan(v) else v
    pairs = sorted((-np.inf if p <= slack else value(lo), np.inf if p >= 1 - slack else value(hi))
                   for p, lo, hi in zip(probs, sketch[0::2], sketch[1::2]))
    for lo, hi in pairs:
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return np.array(out)


def _by_brackets(data: DataFrame, probs: list[float], n_rows: int, slack: float | None = None) -> dict[str, list[float | None]]:
    spark, cols = data.sparkSession, data.columns
    # a bracket takes four errors of the sketch; together they are a tenth of the rows at most
    accuracy = max(1_000, -(-8 * n_rows // limit_of(spark, CELL_ROWS)), 40 * len(probs))
    slack = 2.0 / accuracy if slack is None else slack
    shares = [min(max(s, 0.0), 1.0) for p in probs for s in (p - slack, p + slack)]
    row = data.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
                   *[F.percentile_approx(c, shares, accuracy).alias(f"q{i}") for i, c in enumerate(cols)]).first()
    totals = [row[f"n{i}"] for i in range(len(cols))]
    brackets = {i: _brackets(row[f"q{i}"], probs, slack) for i in range(len(cols)) if totals[i]}

    def count(batches):
        below = {i: np.zeros(len(b) + 1, np.int64) for i, b in brackets.items()}
        for batch in batches:
            parts = []
            for i, b in brackets.items():
                v = batch.column(i).drop_null().to_numpy()
                v = np.where(np.isnan(v), np.inf, v) + 0.0  # one zero
                at = np.searchsorted(b[:, 0], v, "right") - 1
                below[i] += np.bincount(at + 1, minlength=len(b) + 1)
                held = (at >= 0) & (v <= b[np.maximum(at, 0), 1])
                if held.any():
                    values, first, n = np.unique(v[held], return_index=True, return_counts=True)
                    parts.append((np.full(len(values), i), at[held][first], values, n))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(zip(*parts), COUNTS.types)], schema=COUNTS)
        for i, n in below.items():
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(n), pa.int32()), pa.array(range(-1, len(n) - 1), pa.int32()),
                                              pa.nulls(len(n), pa.float64()), pa.array(n)], schema=COUNTS)

    counted = data.mapInArrow(count, "c int, b int, v double, n long").groupBy("c", "b", "v").agg(F.sum("n").alias("n"))
    counted = cut_lineage(counted)
    starts: dict[int, np.ndarray] = {i: np.zeros(len(b) + 2, np.int64) for i, b in brackets.items()}
    for r in counted.filter("v IS NULL").collect():
        starts[r["c"]][r["b"] + 2] = r["n"]
    starts = {i: s.cumsum() for i, s in starts.items()}  # [i][b + 1]: values below bracket b
    wanted = []
    for i in brackets:
        for rank in sorted({r for p in probs for r in _ranks(p, totals[i])}):
            b = int(np.searchsorted(starts[i][1:], rank, "right")) - 1
            wanted.append((i, b, rank, int(rank - starts[i][b + 1])))
    found: dict[tuple[int, int], float] = {}
    if wanted:
        order = Window.partitionBy("c", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        upto = counted.filter("v IS NOT NULL").withColumn("upto", F.sum("n").over(order))
        table = spark.createDataFrame(wanted, "c int, b int, rank long, inside long")
        hit = upto.join(F.broadcast(table), ["c", "b"]).filter("upto > inside AND upto - n <= inside")
        found = {(r["c"], r["rank"]): r["v"] for r in hit.select("c", "rank", "v").collect()}
    out: dict[str, list[float | None]] = {}
    for i, c in enumerate(cols):
        if not totals[i]:
            out[c] = [None] * len(probs)
            continue
        ends = [(_ranks(p, totals[i]), p * (totals[i] - 1)) for p in probs]
        if any((i, r) not in found for pair, _ in ends for r in pair):  # the sketch was off by more than it promises
            out |= _by_brackets(data.select(c), probs, n_rows, 4 * slack)
            continue
        values = [(found[i, lo], found[i, hi], at - lo) for (lo, hi), at in ends]
        out[c] = [lo if lo == hi else lo + (hi - lo) * share for lo, hi, share in values]
    return out


def _ranks(p: float, n: int) -> tuple[int, int]:
    at = p * (n - 1)
    lo = int(at)
    return lo, min(lo + (1 if at > lo else 0), n - 1)
