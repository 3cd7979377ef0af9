"""Input checks as one-pass reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from loomframe.plans.runtime import require_columns


def check_features(df: DataFrame, cols, dtype: str = "double") -> DataFrame:
    """Per column: rows, nulls, NaN and values that cannot be cast. One aggregation."""
    require_columns(df, cols)
    aggs = [F.count("*").alias("n")]
    for i, c in enumerate(cols):
        value = F.col(c).try_cast(dtype)
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"null{i}"),
            F.count_if(F.isnan(value.cast("double"))).alias(f"nan{i}"),
            F.count_if(F.col(c).isNotNull() & value.isNull()).alias(f"bad{i}"),
        ]
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.col(f"null{i}").alias("n_null"),
                 F.col(f"nan{i}").alias("n_nan"), F.col(f"bad{i}").alias("n_uncastable"))
        for i, c in enumerate(cols)
    ])
    return df.agg(*aggs).select(F.inline(rows))


def check_labeled(df: DataFrame, cols, label: str) -> DataFrame:
    """Rows, rows without a label and rows with a missing feature."""
    require_columns(df, [*cols, label])
    incomplete = F.lit(False)
    for c in cols:
        incomplete = incomplete | F.col(c).isNull()
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(label).isNull()).alias("n_unlabeled"),
        F.count_if(incomplete).alias("n_incomplete"),
    )


def require_numeric(df: DataFrame, cols) -> None:
    """Fail before any job when a column is absent or not numeric."""
    require_columns(df, cols)
    wrong = [c for c in cols if not isinstance(df.schema[c].dataType, NumericType)]
    if wrong:
        raise ValueError(f"columns are not numeric: {wrong}")
