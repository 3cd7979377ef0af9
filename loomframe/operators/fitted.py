"""Fitted operators: a kind, plain options and parameter tables; transform is lazy."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from loomframe.plans.runtime import Settled, settle

_TRANSFORMS: dict[str, Callable] = {}


def transform_of(kind: str):
    """Register the transform of a kind, so that a saved fit can be loaded again."""
    def add(fn):
        _TRANSFORMS[kind] = fn
        return fn

    return add


@dataclass
class Fitted:
    kind: str
    options: dict
    tables: dict[str, Settled] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return _TRANSFORMS[self.kind](self, df)


def save_fitted(fitted: Fitted, path: str, spark: SparkSession) -> None:
    """Parameter tables and options as parquet under one folder."""
    names = sorted(fitted.tables)
    head = [(fitted.kind, json.dumps(fitted.options), names)]
    (spark.createDataFrame(head, "kind string, options string, tables array<string>")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/options"))
    for name in names:
        fitted.tables[name].df.write.mode("overwrite").parquet(f"{path}/tables/{name}")


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    head = spark.read.parquet(f"{path}/options").first()
    tables = {n: settle(spark.read.parquet(f"{path}/tables/{n}")) for n in head["tables"]}
    return Fitted(head["kind"], json.loads(head["options"]), tables)
