"""Running sums, ranks and frames over ordered groups of any size.

A window partitioned by a group key puts the whole group into one task. Here a group is
first divided into cells of bounded size along its order, if any group is larger than a cell; a cell is what one task
sorts. Totals of the cells (a small table) give each cell the sum of all cells before it.
Cell bounds are literals taken from approximate quantiles (or cells are parts of a stored copy), so that every evaluation
and every task retry sees the same cells.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.plans.runtime import CELL_ROWS, cut_lineage, limit_of, null_safe_join

# Above so many cells (and for orders that are not numbers) cells are the parts of a range-partitioned copy.
MAX_CELLS = 10_000
NUMBERS = {"byte", "short", "integer", "long", "float", "double", "decimal", "timestamp", "boolean"}


def cell_count(df: DataFrame, n_rows: int) -> int:
    return -(-n_rows // limit_of(df.sparkSession, CELL_ROWS))


def numeric(df: DataFrame, lead: Column) -> Column | None:
    """The order column as a number that grows with it, or None if its type has none (texts)."""
    kind = df.select(lead.alias("lead")).schema[0].dataType.typeName()
    if kind == "date":
        return F.unix_date(lead)
    if kind == "timestamp_ntz":
        return lead.cast("timestamp")
    return lead if kind in NUMBERS else None


def quantile_values(df: DataFrame, lead: Column, n_rows: int) -> list[float]:
    """The values at the inner bounds of about n_rows / cellRows cells of equal weight, repeated for copies."""
    cells = cell_count(df, n_rows)
    if cells <= 1:
        return []
    probs = [i / cells for i in range(1, cells)]
    row = df.agg(F.percentile_approx(lead.cast("double"), probs, max(10_000, 20 * cells)).alias("q")).first()
    return [float(v) for v in (row["q"] or []) if v is not None]


def cell_bounds(df: DataFrame, lead: Column, n_rows: int) -> list[float]:
    """Inner bounds of the cells (empty: one cell)."""
    return sorted(set(quantile_values(df, lead, n_rows)))


def hot_values(found: list[float]) -> list[float]:
    """Values that fill more than one cell alone (copies of one time stamp, say): repeated quantiles."""
    return sorted({a for a, b in zip(found, found[1:]) if a == b})


def split_hot(df: DataFrame, lead: Column, tie: Column, hot: list[float], bounds: list[float]) -> DataFrame:
    """Cells over (lead, tie): a hot value of lead gets a cell of its own, cut further along the tie column.

    The cuts of all hot values come from one grouped aggregation, and a row finds its own in a map of arrays.
    """
    limit = limit_of(df.sparkSession, CELL_ROWS)
    alone = sorted({*bounds, *hot, *[math.nextafter(v, math.inf) for v in hot]})
    out = add_cell(df, lead, alone)
    value = lead.cast("double")
    sizes = {r["v"]: r["n"] for r in df.filter(value.isin(hot)).groupBy(value.alias("v")).agg(F.count("*").alias("n")).collect()}
    most = max(-(-n // limit) for n in sizes.values())
    probs = [i / most for i in range(1, most)]
    cuts = {}
    if probs:
        rows = df.filter(value.isin(hot)).groupBy(value.alias("v")).agg(
            F.percentile_approx(tie.cast("double"), probs, max(10_000, 20 * most)).alias("q"))
        cuts = {r["v"]: sorted({float(x) for x in r["q"] or []}) for r in rows.collect()}
    part = F.lit(0.0)
    if any(cuts.values()):
        own = F.element_at(F.create_map(*[x for v, q in cuts.items() for x in (F.lit(v), F.array(*[F.lit(c) for c in q]).cast("array<double>"))]), value)
        part = F.coalesce(F.size(F.filter(own, lambda c: c <= tie.cast("double"))).cast("double"), F.lit(0.0))
    return out.withColumn("_cell", F.col("_cell") * F.lit(float(most + 1)) + F.when(value.isin(hot), part).otherwise(0.0))


def range_cells(df: DataFrame, lead: Column, tie: Column | None, n_rows: int) -> DataFrame:
    """Cells along an order of any type: the parts of a range-partitioned copy, written once so that they stay as they are."""
    order = [lead] if tie is None else [lead, tie]
    return cut_lineage(df.repartitionByRange(cell_count(df, n_rows), *order).withColumn("_cell", F.spark_partition_id().cast("double")))


def add_cell(df: DataFrame, lead: Column, bounds: list[float], name: str = "_cell") -> DataFrame:
    """Cell number of each row: a binary search over the literal bounds, inside the JVM."""
    if not bounds:
        return df.withColumn(name, F.lit(0.0))
    source = f"{name}_lead"
    splits = [float("-inf"), *bounds, float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol=source, outputCol=name, handleInvalid="keep")
    out = bucketizer.transform(df.withColumn(source, lead.cast("double")))
    return out.withColumn(name, F.when(F.col(source).isNull(), -1.0).otherwise(F.col(name))).drop(source)  # NULLs come first


class Ordered:
    """Rows in a total order inside groups, held in cells of bounded size."""

    def __init__(self, df: DataFrame, keys, order, lead: Column, n_rows: int | None = None,
                 derived: bool = False, tie: Column | None = None):
        """With derived, an input that comes from an aggregation is written out once before it is cut.

        `tie` is the number that orders rows of equal lead; it lets many copies of one lead be cut too.
        """
        self.keys = list(keys)
        self.order = list(order)
        n = df.count() if n_rows is None else n_rows
        self.n_rows = n
        if derived and n > limit_of(df.sparkSession, CELL_ROWS):
            df = cut_lineage(df)
        self.split = cell_count(df, n) > 1 and self._crowded(df)
        self.df = df
        if self.split:
            number = numeric(df, lead) if cell_count(df, n) <= MAX_CELLS else None
            if number is None or (tie is not None and numeric(df, tie) is None):
                self.df = range_cells(df, lead, tie, n)
            else:
                found = quantile_values(df, number, n)
                bounds = sorted(set(found))
                hot = hot_values(found) if tie is not None else []
                self.split = bool(bounds)
                self.df = split_hot(df, number, numeric(df, tie), hot, bounds) if hot else add_cell(df, number, bounds)
        self.parts = self.keys + (["_cell"] if self.split else [])

    def _crowded(self, df: DataFrame) -> bool:
        """Whether any group holds more rows than a cell may."""
        if not self.keys:
            return True
        return not df.groupBy(*self.keys).count().filter(F.col("count") > limit_of(df.sparkSession, CELL_ROWS)).isEmpty()

    def _combine(self, op, value):
        return {"sum": F.sum, "max": F.max, "min": F.min}[op](value)

    def running(self, reverse: bool = False, **outs) -> "Ordered":
        """Add inclusive running aggregates, given as name=(op, Column) with op sum, max or min.

        With reverse, a row sees itself and all rows after it.
        """
        # backwards means descending order: a frame up to unboundedFollowing would be quadratic
        turn = (lambda c: c.desc()) if reverse else (lambda c: c)
        inside = (Window.partitionBy(*self.parts).orderBy(*[turn(c) for c in self.order])
                  .rowsBetween(Window.unboundedPreceding, 0))
        out = self.df
        totals = None
        if self.split:
            aggs = [self._combine(op, v).alias(f"_t_{name}") for name, (op, v) in outs.items()]
            totals = out.groupBy(*self.parts).agg(*aggs)
            before = (Window.partitionBy(*self.keys).orderBy(turn(F.col("_cell")))
                      .rowsBetween(Window.unboundedPreceding, -1))
            totals = totals.select(
                *self.parts,
                *[self._combine(op, F.col(f"_t_{n}")).over(before).alias(f"_b_{n}")
                  for n, (op, _) in outs.items()],
            )
        out = out.select(
            "*", *[self._combine(op, v).over(inside).alias(n) for n, (op, v) in outs.items()]
        )
        if self.split:
            out = null_safe_join(out, totals, self.parts)
            for n, (op, _) in outs.items():
                prev, own = F.col(f"_b_{n}"), F.col(n)
                if op == "sum":
                    merged = F.when(own.isNull(), prev).when(prev.isNull(), own).otherwise(own + prev)
                elif op == "max":
                    merged = F.greatest(own, prev) if not _is_struct(out, n) else _pick(own, prev, True)
                else:
                    merged = F.least(own, prev) if not _is_struct(out, n) else _pick(own, prev, False)
                out = out.withColumn(n, merged)
            out = out.drop(*[f"_b_{n}" for n in outs])
        return self._with(out)

    def positions(self, name: str = "pos") -> "Ordered":
        """Zero-based position of every row inside its group."""
        done = self.running(**{name: ("sum", F.lit(1).cast("long"))})
        return done._with(done.df.withColumn(name, F.col(name) - 1))

    def _with(self, df: DataFrame) -> "Ordered":
        clone = object.__new__(Ordered)
        clone.__dict__.update(self.__dict__)
        clone.df = df
        return clone

    def rows(self) -> DataFrame:
        return self.df.drop("_cell")


def _is_struct(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() == "struct"


def _pick(a: Column, b: Column, larger: bool) -> Column:
    keep_a = (a >= b) if larger else (a <= b)
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.when(keep_a, a).otherwise(b))


class Frames:
    """Series cut into blocks with halo rows, for windows that look a fixed number of rows around.

    `df` carries the columns `pos` (position in the series) and `_core` (False on halo rows).
    Windows are written over `window`; afterwards `finish` drops the halo rows.
    """

    def __init__(self, df: DataFrame, keys, order, lead: Column, before: int = 0, after: int = 0,
                 tie: Column | None = None):
        spark = df.sparkSession
        ordered = Ordered(df, keys, order, lead, tie=tie).positions("pos")
        rows = ordered.rows()
        if not ordered.split:
            self.df = rows.withColumn("_core", F.lit(True))
            self.parts = list(keys)
        else:
            size = max(limit_of(spark, CELL_ROWS), before, after, 1)
            block, offset = F.floor(F.col("pos") / size), F.col("pos") % size
            targets = F.array_compact(F.array(
                block,
                F.when(offset >= size - before, block + 1),
                F.when((offset < after) & (block > 0), block - 1),
            ))
            self.df = (
                rows.withColumn("_home", block)
                .withColumn("_block", F.explode(targets))
                .withColumn("_core", F.col("_home") == F.col("_block"))
                .drop("_home")
            )
            self.parts = [*keys, "_block"]
        self.window = Window.partitionBy(*self.parts).orderBy("pos")

    @staticmethod
    def finish(df: DataFrame) -> DataFrame:
        return df.filter("_core").drop("_core", "_block")
