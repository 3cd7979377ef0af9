"""Categorical encoders: a group-by to fit, a left join with the small table to transform."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.arrays import EPSILON
from loomframe.operators.fitted import Fitted, transform_of
from loomframe.plans.ordering import Ordered
from loomframe.plans.runtime import (
    CELL_ROWS, limit_of, null_safe_join, require_columns, settle)


@transform_of("lookup")
def _lookup(fit: Fitted, df: DataFrame) -> DataFrame:
    """Add <column><suffix> for every fitted column; unknown categories get the default or an error."""
    out = df
    for c, default in fit.options["columns"].items():
        name = f"{c}{fit.options['suffix']}"
        pairs = fit.tables[c]
        table = pairs.df.select(F.col("category").alias(c), F.col("code").alias(name))
        out = null_safe_join(out, F.broadcast(table) if pairs.small else table, [c])
        if fit.options.get("unknown") == "error":
            fail = F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))))
            out = out.withColumn(name, F.coalesce(F.col(name), fail.cast("long")))
        else:
            out = out.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    return out


def sorted_codes(df: DataFrame, col: str) -> DataFrame:
    """(category, code): rank among the sorted distinct values."""
    cats = df.groupBy(col).agg(F.count("*").alias("_n")).select(F.col(col).alias("category"))
    cats = cats.filter("category IS NOT NULL")
    n = cats.count()
    if n <= limit_of(df.sparkSession, CELL_ROWS):
        return cats.select("category", (F.row_number().over(Window.orderBy("category")) - 1).cast("long").alias("code"))
    # many categories: in cells of bounded size along their own order
    return Ordered(cats, [], [F.col("category")], F.col("category"), n, derived=True).positions("code").rows().select("category", "code")


def label_encode(df: DataFrame, cols, unknown: str = "error", suffix: str = "_code") -> Fitted:
    require_columns(df, cols)
    tables = {c: settle(sorted_codes(df, c)) for c in cols}
    return Fitted("lookup", {"columns": {c: -1 for c in cols}, "suffix": suffix, "unknown": unknown}, tables)


def ordinal_encode(df: DataFrame, cols, categories: dict[str, list] | None = None, unknown: str = "error",
                   suffix: str = "_ord") -> Fitted:
    """Codes by given or sorted categories; with unknown='ignore' others become -1."""
    if unknown not in ("error", "ignore"):
        raise ValueError("unknown must be 'error' or 'ignore'")
    require_columns(df, cols)
    tables = {}
    for c in cols:
        if categories and c in categories:
            kind = df.schema[c].dataType.simpleString()
            rows = [(v, i) for i, v in enumerate(categories[c])]
            tables[c] = settle(df.sparkSession.createDataFrame(rows, f"category {kind}, code long"))
        else:
            tables[c] = settle(sorted_codes(df, c))
    return Fitted("lookup", {"columns": {c: -1 for c in cols}, "suffix": suffix, "unknown": unknown}, tables)


def one_hot_encode(df: DataFrame, cols, unknown: str = "error", most_columns: int = 500) -> Fitted:
    """One 0/1 column per category (<column>_<category>). For more categories use one_hot_rows."""
    require_columns(df, cols)
    if unknown not in ("error", "ignore"):
        raise ValueError("unknown must be 'error' or 'ignore'")
    cats = {}
    for c in cols:
        found = [row["category"] for row in
                 sorted_codes(df, c).orderBy("code").limit(most_columns + 1).collect()]
        if len(found) > most_columns:
            raise ValueError(f"{c} has more than {most_columns} categories; use one_hot_rows")
        cats[c] = found
    return Fitted("one_hot", {"categories": cats, "unknown": unknown})


@transform_of("one_hot")
def _one_hot(fit: Fitted, df: DataFrame) -> DataFrame:
    made = []
    for c, cats in fit.options["categories"].items():
        for v in cats:
            hit = F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0))
            if fit.options["unknown"] == "error":
                fail = F.raise_error(F.concat(F.lit(f"unknown category in {c}: "),
                                              F.coalesce(F.col(c).cast("string"), F.lit("NULL"))))
                hit = F.when(F.col(c).isin(cats), hit).otherwise(fail.cast("double"))
            made.append(hit.alias(f"{c}_{v}"))
    return df.select("*", *made)


def one_hot_rows(df: DataFrame, id_cols, cols) -> DataFrame:
    """Sparse form for any number of categories: (ids, feature, idx, 1.0)."""
    fit = label_encode(df, cols)
    coded = fit.transform(df)
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}_code").alias("idx")) for c in cols])
    return coded.select(*id_cols, F.inline(pairs)).withColumn("value", F.lit(1.0))


def target_encode(df: DataFrame, cols, target: str, smoothing: float = 10.0, suffix: str = "_te") -> Fitted:
    """(n * mean + s * global) / (n + s) per category; unknown categories get the global mean."""
    require_columns(df, [*cols, target])
    y = F.col(target).cast("double")
    mean = df.agg(F.avg(y).alias("g")).first()["g"]
    tables = {}
    for c in cols:
        # without any target all codes are NULL
        code = (F.sum(y) + F.lit(smoothing) * F.lit(mean).cast("double")) / (F.count(y) + F.lit(float(smoothing)))
        tables[c] = settle(df.groupBy(F.col(c).alias("category")).agg(code.alias("code")))
    return Fitted("lookup", {"columns": {c: mean for c in cols}, "suffix": suffix}, tables)


def frequency_encode(df: DataFrame, cols, suffix: str = "_freq") -> Fitted:
    require_columns(df, cols)
    n = df.count()
    tables = {c: settle(df.groupBy(F.col(c).alias("category")).agg((F.count("*") / F.lit(float(n))).alias("code")))
              for c in cols}
    return Fitted("lookup", {"columns": {c: 0.0 for c in cols}, "suffix": suffix}, tables)


def woe_encode(df: DataFrame, cols, target: str, suffix: str = "_woe") -> Fitted:
    """ln of the odds inside each category; the target must hold exactly the values 0 and 1."""
    require_columns(df, [*cols, target])
    values = {row[0] for row in df.select(target).distinct().limit(3).collect()}
    if values != {0, 1}:
        raise ValueError("woe_encode needs a binary target with the values 0 and 1")
    y = F.col(target)
    rate = lambda v: F.avg(F.when(y == v, 1.0).otherwise(0.0)) + F.lit(EPSILON)
    tables = {c: settle(df.groupBy(F.col(c).alias("category")).agg(F.log(rate(1) / rate(0)).alias("code")))
              for c in cols}
    return Fitted("lookup", {"columns": {c: 0.0 for c in cols}, "suffix": suffix}, tables)
