"""Chains of fitted steps and user functions over partitions and groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Steps:
    """Named or unnamed steps; each is a function DataFrame -> Fitted, or has fit/transform.

    Every fit runs one aggregation on the lazily composed prefix; transform stays one projection chain.
    """

    def __init__(self, steps):
        self.steps = [s if isinstance(s, tuple) else (f"step_{i}", s) for i, s in enumerate(steps)]
        self.fitted: list[tuple[str, object]] = []

    def fit(self, df: DataFrame) -> "Steps":
        self.fit_transform(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if len(self.fitted) != len(self.steps):
            raise ValueError("steps are not fitted")
        for _, fit in self.fitted:
            df = fit.transform(df)
        return df

    def fit_transform(self, df: DataFrame) -> DataFrame:
        self.fitted = []
        for name, step in self.steps:
            fit = step.fit(df) if hasattr(step, "fit") else step(df)
            self.fitted.append((name, fit))
            df = fit.transform(df)
        return df


def parallel_map(df: DataFrame, func: Callable, schema: str) -> DataFrame:
    """func(pandas.DataFrame) -> pandas.DataFrame over batches of rows."""
    def run(batches):
        for pdf in batches:
            yield func(pdf)

    return df.mapInPandas(run, schema)


def parallel_apply(df: DataFrame, func: Callable, column: str, returns: str, out: str) -> DataFrame:
    """func(pandas.Series) -> pandas.Series on one column."""
    return df.withColumn(out, F.pandas_udf(func, returns)(F.col(column)))
