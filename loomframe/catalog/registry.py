"""Named queries over the test tables, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r(c, places: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, places)


def rounded(df: DataFrame, cols, places: int = 6) -> DataFrame:
    cols = set(cols)
    return df.select(*[r(c, places).alias(c) if c in cols else F.col(c) for c in df.columns])


# Key columns of lineitem (unique together) and the SQL for its row id.
LI_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LI_ID_SQL = "l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber"
