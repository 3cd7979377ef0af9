"""Mixing sources to target weights: whole epochs of each source, then a weighted draw of the rest.

The draw is Efraimidis-Spirakis: every document gets an exponential key whose rate is its quality weight, and the smallest
keys are taken until the words of the source's target are reached (the document at the border is taken if that ends
nearer to the target). Keys come from a hash, so reruns agree.

No source is sorted as a whole: word totals per slice of the key range say in which slice the border lies, slices below
it are taken whole, and only the slice of the border is sorted.

Nulls and edge cases: a null text has size 0, so nothing of it is taken; a null source is a source of its own, last in
order; a null doc_id counts as the empty text in the hash. Documents of equal keys (repeated rows) are drawn in the order of
doc_id and place in the table. An empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomframe.functions.keys import hash_key, key_number
from loomframe.llm.common import SPACE_WORD, col, columns, fresh, text_of, written

# Slices of the key range; the slice at a source's border is sorted.
SLICES = 4096


def default_quality(text: Column, size: Column) -> Column:
    """A weight in (0, 1]: 1 for texts of six characters to a word (the space included), less the farther from that."""
    per_word = F.char_length(text) / F.greatest(size, F.lit(1))
    return 1.0 / (1.0 + F.abs(per_word - 6.0) / 6.0)


def ranked(df: DataFrame, order: list, name: str) -> DataFrame:
    """The table with its row numbers from 0 in an order: sorted in parts, each part shifted by the rows before it."""
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(name), 33)
    before, offsets = 0, []
    for r in placed.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row per task that wrote
        offsets.append((r["part"], before))
        before += r["count"]
    if not offsets:
        return placed
    shifts = df.sparkSession.createDataFrame(offsets, "_part long, _before long")
    within = F.col(name).bitwiseAND(F.lit((1 << 33) - 1).cast("long"))
    return (placed.withColumn("_part", part.cast("long")).join(shifts, "_part")
            .withColumn(name, F.col("_before") + within).drop("_part", "_before"))


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order (null last) get the weights in turn, and share `share` times all words. A target stops
    at `most` times its source's words; what is over is shared again by weight until no target is above its bound.
    """
    rows = ranked(sizes, [F.col("source").asc_nulls_last()], "_rank")
    turn = (F.col("_rank") % len(weights)).cast("int")
    rows = written(rows.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
                   .withColumn("bound", F.col("source_size") * float(most)))
    budget = (rows.agg(F.sum("source_size").alias("n")).first()["n"] or 0) * float(share)
    rate, bounded = 0.0, -1
    while True:  # the rate only grows, and with it the set of sources at their bound
        full = (F.col("bound") <= F.lit(rate) * F.col("weight")) & F.lit(bounded >= 0)
        r = rows.agg(F.count(F.when(full, 1)).alias("n"), F.sum(F.when(full, F.col("bound")).otherwise(0.0)).alias("taken"),
                     F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if not r["weight"]:
            rate = float("inf")
            break
        if r["n"] == bounded:
            break
        bounded, rate = r["n"], (budget - r["taken"]) / r["weight"]
    return rows.select("source", "source_size", F.least("bound", F.lit(rate) * F.col("weight")).alias("target"))


def sized(docs: DataFrame, quality: Column | None, seed: int, id_col: str, text_col: str, source_col: str,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """What the mix needs of each document: doc_id, source, size, key, its slice and place, and columns to keep."""
    text = text_of(text_col)
    size = F.regexp_count(text, F.lit(SPACE_WORD)).cast("long")
    rows = docs.select(*columns(keep), col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"), size.alias("size"),
                       (default_quality(text, size) if quality is None else quality.cast("double")).alias("quality"),
                       hash_key(seed, F.coalesce(col(id_col).cast("string"), F.lit("")), F.md5(text)).alias("_key"))
    u = (key_number(F.col("_key"), 1, 12).cast("double") + 0.5) / float(1 << 48)
    rows = rows.withColumn("key", -F.log(u) / F.greatest(F.coalesce("quality", F.lit(1.0)), F.lit(1e-6))).drop("_key")
    return rows.withColumn("slice", F.floor((1.0 - F.exp(-F.col("key"))) * SLICES).cast("int")).withColumn(
        "place", F.monotonically_increasing_id())


def draw_plan(rows: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """A row per source: source_size, target, epochs, the slice of its border, and the last draw (`cut`) in that slice."""
    sliced = written(rows.groupBy("source", "slice").agg(F.sum("size").alias("words")))
    targets = source_targets(sliced.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("epochs", epochs.cast("int"))
    targets = written(targets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    # the slice in which a source's rest is reached, and the words of the slices below it
    until = F.sum("words").over(W.partitionBy("source").orderBy("slice"))
    border = (by_source(sliced.withColumn("until", until), targets).filter("until >= rest").groupBy("source")
              .agg(F.min(F.struct("slice", (F.col("until") - F.col("words")).alias("below"))).alias("at")))
    plan = by_source(targets, border.select("source", F.col("at.slice").alias("border"), F.col("at.below").alias("below")))
    plan = written(plan)
    order = W.partitionBy("source").orderBy("key", "doc_id", "place").rowsBetween(W.unboundedPreceding, W.currentRow)
    near = by_source(rows, plan).filter("slice = border").withColumn("after", F.col("below") + F.sum("size").over(order))
    cut = (near.filter(2 * F.col("after") - F.col("size") <= 2 * F.col("rest")).groupBy("source")
           .agg(F.max(F.struct("key", "doc_id", "place")).alias("cut")))
    return written(by_source(plan, cut, "left"))


def by_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def copies() -> Column:
    """How often a row is taken, from the columns of `sized` and `draw_plan`."""
    drawn = (F.col("slice") < F.col("border")) | ((F.col("slice") == F.col("border"))
                                                  & F.coalesce(F.struct("key", "doc_id", "place") <= F.col("cut"), F.lit(False)))
    return F.col("epochs") + drawn.cast("int")


def mix(docs: DataFrame, weights: list[float], share: float, most: float = 2.0, quality: Column | None = None, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, quality, source_size, target, copies (times the document is taken) and taken (its words).

    `share` is the mix's size as a share of all words, `most` the most epochs of a source. No document is taken more
    often than `most` rounded up.
    """
    rows = written(sized(docs, quality, seed, id_col, text_col, source_col))
    told = by_source(rows, draw_plan(rows, weights, share, most)).withColumn("copies", copies())
    return told.select("doc_id", "source", "size", "quality", "source_size", "target", "copies",
                       (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: list[float], share: float, most: float = 2.0, seed: int = 17, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row as often as it is taken, with the table's own columns.

    `docs` should be a stored table: rows are told apart by their place in it. Texts are not shuffled: whether a row is
    drawn follows from its own key and its source's row of the plan.
    """
    (row,) = fresh(docs, "_row")
    packed = docs.select(F.struct(*columns(docs.columns)).alias(row), *[col(c) for c in dict.fromkeys((id_col, text_col, source_col))])
    rows = sized(packed, None, seed, id_col, text_col, source_col, (row,))
    plan = draw_plan(written(rows.drop(row)), weights, share, most)
    taken = by_source(rows, plan).withColumn("copies", copies()).filter("copies > 0")
    return taken.withColumn("copies", F.explode(F.sequence(F.lit(1), "copies"))).select(
        *[F.col(row).getField(c).alias(c) for c in docs.columns])
