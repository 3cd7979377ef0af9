"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "json", "csv", "orc")


def _known(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {FORMATS}")
    return fmt


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Load a table; csv and json should be given a schema, so that no extra pass infers it."""
    reader = spark.read.format(_known(fmt)).options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", True))
    return (reader.schema(schema) if schema is not None else reader).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by=(), **options) -> None:
    writer = df.write.format(_known(fmt)).mode(mode).options(**options)
    if fmt == "csv":
        writer = writer.option("header", options.get("header", True))
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_labeled(df: DataFrame, cols, label: str, path: str) -> None:
    """One parquet table with `features array<double>` and `label`."""
    df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("features"),
              F.col(label).alias("label")).write.mode("overwrite").parquet(path)


def read_labeled(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    missing = {"features", "label"} - set(df.columns)
    if missing:
        raise ValueError(f"not a labeled table, missing {sorted(missing)}")
    return df.select("features", "label")
