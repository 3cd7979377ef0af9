"""Imputation of missing values (SQL NULL)."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.functions.scalar import FLOAT_EPS
from loomframe.operators.contract import require_numeric
from loomframe.operators.fitted import Fitted, transform_of
from loomframe.operators.series import _lead, _tie
from loomframe.plans.nearest import knn_join
from loomframe.plans.ordering import Ordered
from loomframe.plans.quantiles import quantiles
from loomframe.plans.runtime import require_columns


def nan_to_null(df: DataFrame, cols) -> DataFrame:
    """Sources that mark missing values by NaN: turn them to NULL once, at the scan."""
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def impute(df: DataFrame, cols, strategy: str = "mean", fill_value=None, approximate: bool = False) -> Fitted:
    """Fill by mean, median, most_frequent (smallest on ties) or a constant."""
    require_columns(df, cols)
    if strategy == "mean":
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)]).first()
        values = {c: row[f"v{i}"] for i, c in enumerate(cols)}
    elif strategy == "median":
        values = {c: q[0] for c, q in quantiles(df, cols, [0.5], approximate).items()}
    elif strategy == "most_frequent":
        values = {}
        for c in cols:
            counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
            best = counts.agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(c).alias("v"))).alias("b")).first()["b"]
            values[c] = None if best is None else best["v"]
    elif strategy == "constant":
        if fill_value is None:
            raise ValueError("fill_value is required for the constant strategy")
        values = {c: fill_value for c in cols}
    else:
        raise ValueError("strategy must be mean, median, most_frequent or constant")
    return Fitted("fill", {"columns": values})


@transform_of("fill")
def _fill(fit: Fitted, df: DataFrame) -> DataFrame:
    new = fit.options["columns"]
    return df.select(*[F.coalesce(F.col(c), F.lit(new[c])).alias(c) if new.get(c) is not None else F.col(c)
                       for c in df.columns])


def knn_impute(df: DataFrame, id_col: str, cols, k: int = 5, weights: str = "uniform") -> DataFrame:
    """Fill missing cells by the mean over the k nearest complete rows.

    Distances use the columns the row has; rows of all patterns of missing columns are searched in one join. Rows without
    any value stay as they are.
    """
    if k < 1:
        raise ValueError("k must be positive")
    if weights not in ("uniform", "distance"):
        raise ValueError("weights must be 'uniform' or 'distance'")
    require_numeric(df, cols)
    values = [F.col(c).cast("double") for c in cols]
    data = df.select(F.col(id_col).alias("id"), F.array(*values).alias("vec"))
    lost = F.size(F.filter("vec", lambda v: v.isNull()))
    sizes = data.agg(F.count_if(lost == 0).alias("complete"), F.count_if((lost > 0) & (lost < len(cols))).alias("partly")).first()
    if sizes["complete"] == 0:
        raise ValueError("no complete rows to learn from")
    if sizes["partly"] == 0:
        return df
    complete = data.filter(lost == 0).withColumnRenamed("id", "point_id")
    partly = data.filter((lost > 0) & (lost < len(cols))).withColumnRenamed("id", "query_id")
    near = knn_join(partly, complete, k, n_queries=sizes["partly"], n_points=sizes["complete"], masked=True)
    w = F.lit(1.0) if weights == "uniform" else 1.0 / (F.col("distance") + FLOAT_EPS)
    filled = near.join(complete, "point_id").groupBy("query_id").agg(
        *[(F.sum(w * F.col("vec")[i]) / F.sum(w)).alias(f"_f_{i}") for i in range(len(cols))])
    joined = df.join(filled, df[id_col] == filled["query_id"], "left").drop("query_id")
    place = {c: i for i, c in enumerate(cols)}
    return joined.select(*[F.coalesce(F.col(c).cast("double"), F.col(f"_f_{place[c]}")).alias(c) if c in place else F.col(c)
                           for c in df.columns])


def interpolate(df: DataFrame, series, order, value: str, method: str = "linear",
                max_gap: int | None = None, lead=None, out: str | None = None) -> DataFrame:
    """Fill a series by row position: linear (ends held flat), forward or backward within max_gap rows.

    The known value before (after) a row is the running maximum (minimum from the end) of
    (position, value), which works across cells, so that one long series is no bottleneck.
    """
    if method not in ("linear", "forward", "backward"):
        raise ValueError("method must be linear, forward or backward")
    out = out or value
    series = [series] if isinstance(series, str) else list(series)
    order = [order] if isinstance(order, str) else list(order)
    require_columns(df, [*series, *order, value])
    rows = Ordered(df, series, [F.col(c) for c in order], _lead(df, order, lead), tie=_tie(df, order)).positions("_pos")
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(value).cast("double").alias("v")))
    if method in ("linear", "forward"):
        rows = rows.running(_prev=("max", known))
    if method in ("linear", "backward"):
        rows = rows.running(reverse=True, _next=("min", known))
    x, pos = F.col(value).cast("double"), F.col("_pos")
    if method == "linear":
        prev, nxt = F.col("_prev"), F.col("_next")
        step = F.try_divide(nxt["v"] - prev["v"], nxt["p"] - prev["p"])
        filled = (F.when(prev["p"].isNull(), nxt["v"]).when(nxt["p"].isNull(), prev["v"])
                  .otherwise(prev["v"] + step * (pos - prev["p"])))
    else:
        side = F.col("_prev") if method == "forward" else F.col("_next")
        filled = side["v"] if max_gap is None else F.when(F.abs(pos - side["p"]) <= max_gap, side["v"])
    return rows.rows().withColumn(out, F.coalesce(x, filled)).drop("_pos", "_prev", "_next")
