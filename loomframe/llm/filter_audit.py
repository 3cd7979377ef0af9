"""How filters interact: what each removes in every order, and its Shapley share through the potential of the removal game.

The players are filters, and a coalition's worth is the number of documents that fail at least one of its filters. A
document is a mask of the filters it fails, so the worth of all 32 coalitions follows from the counts of 32 masks. The
potential of Hart and Mas-Colell is built up over coalitions by size,

    P(S) = (worth(S) + sum of P(S without i) over i in S) / |S|,    P(of none) = 0,

and the Shapley value of a filter is P(all) - P(all without it). It is kept times the number of orders, which makes every
potential an integer. A step of an order is the difference of two coalitions: those before it, with and without its filter.

One pass over the texts gives a row of facts a document (mask, SHA-256 of the text). Copies are found by a minimum per
digest, which is aggregated before it is shuffled, and a join on (digest, id), so that a text copied very often makes no
large group. Texts of equal digest count as identical.

Nulls and edge cases: a null text is the empty text; a null part is the empty string. A document without an id is never
a copy nor makes one, and has no label. Rows of one id and text are no copies of each other. Where labels repeat an id, one
label of the kind is enough. Very long texts are read in pieces; their distinct words are held at once. Documents that
fail nothing are counted as kept; an empty table gives no row. Other columns of the tables are not read.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import col, text_of, written
from loomframe.llm.simhash_dedup import _pieces

FILTERS = "ABCDE"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = b"#$%&*|"
CONTINUATION = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Limits:
    """Failure: under so many words (A), under so many distinct words of a hundred (B), over so many capitals of a hundred code points (C)."""

    words: int = 200
    distinct: int = 50
    capitals: int = 3


def failures(data: bytes, limits: Limits = Limits()) -> int:
    """The mask of the filters A to D that a text in UTF-8 fails."""
    words, distinct = 0, set()
    for piece in _pieces(data):
        words += len(piece)
        distinct.update(piece)
    points = len(data) - (0 if data.isascii() else len(data) - len(data.translate(None, CONTINUATION)))
    capitals = len(data) - len(data.translate(None, CAPITALS))
    signs = len(data.translate(None, SIGNS)) < len(data)
    return ((words < limits.words) | (100 * len(distinct) < limits.distinct * words) << 1
            | (100 * capitals > limits.capitals * points) << 2 | signs << 3)


def document_facts(docs: DataFrame, part: Column, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, part, mask (filters A to D) and digest of each document."""
    source = docs.select(col(id_col).alias("doc_id"), part.alias("part"), text_of(text_col).cast("binary").alias("data"))
    schema = source.drop("data").schema.add("mask", "integer").add("digest", "binary")

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                rows = batch.slice(i, 256)
                data = rows.column(2)
                masks = pa.array([failures(t.as_py(), limits) for t in data], pa.int32())
                digests = pa.array([hashlib.sha256(t.as_buffer()).digest() for t in data], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), masks, digests], names=["doc_id", "part", "mask", "digest"])

    return source.mapInArrow(run, schema)


def with_copies(facts: DataFrame) -> DataFrame:
    """The facts with E in the mask of documents whose text is that of a smaller id."""
    first = facts.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    joined = facts.join(first, ["digest", "doc_id"], "left")
    return joined.select("doc_id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))


def mask_counts(masked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """part, mask, docs, good and toxic: how many documents there are of each mask."""
    marks = labels.groupBy(col(id_col).alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.filter("good = 1 OR toxic = 1")
    return masked.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("docs"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def coalition_worths(counts: DataFrame, kinds: tuple[str, ...] = ("docs", "good", "toxic"), players: int = len(FILTERS)) -> DataFrame:
    """A row per part: `total`, and for each kind an array, by coalition, of what fails at least one of its filters.

    A part has at most as many rows as there are masks, so gathering them is bounded.
    """
    def worth(kind):
        def of(s):
            return F.aggregate("masks", F.lit(0).cast("long"), lambda so_far, m: so_far + F.when(m["mask"].bitwiseAND(s) != 0, m[kind]).otherwise(0))

        return F.transform(F.sequence(F.lit(0), F.lit((1 << players) - 1)), of)

    gathered = counts.groupBy("part").agg(F.sum("docs").alias("total"), F.collect_list(F.struct("mask", *kinds)).alias("masks"))
    return gathered.select("part", "total", *[worth(k).alias(k) for k in kinds])


def with_potentials(worths: DataFrame, worth: str = "docs", players: int = len(FILTERS)) -> DataFrame:
    """`potential`, an array by coalition: the Hart-Mas-Colell potential times the number of orders.

    Coalitions are visited as ascending masks, so those with one filter less are known; the size divides every sum.
    """
    def potential(known, s):
        total = F.element_at(worth, s + 1) * factorial(players)
        for i in range(players):
            total = total + F.when(s.bitwiseAND(1 << i) != 0, F.get(known, s.bitwiseXOR(F.lit(1 << i)))).otherwise(0)
        return F.array_append(known, F.call_function("div", total, F.bit_count(s)))

    start = F.array(F.lit(0).cast("long"))
    return worths.withColumn("potential", F.aggregate(F.sequence(F.lit(1), F.lit((1 << players) - 1)), start, potential))


def order_steps(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, mask of the filters before, the filter's place in `filters`) of all orders."""
    out = []
    for order in permutations(filters):
        before = 0
        for step, letter in enumerate(order, 1):
            i = filters.index(letter)
            out.append(("".join(order), step, before, i))
            before |= 1 << i
    return out


def audit(worths: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, filter_order and step from the coalitions' worths and potentials."""
    names = ("filter_order", "step", "before", "place")
    rows = json.dumps([dict(zip(names, row)) for row in order_steps(filters)])
    rows = F.from_json(F.lit(rows), "array<struct<filter_order:string,step:int,before:int,place:int>>")
    table = worths.select("*", F.inline(rows))
    everyone = (1 << len(filters)) - 1
    own = F.expr("shiftleft(1, place)")
    after = F.col("before").bitwiseOR(own)

    def of(kind, coalition):
        return F.element_at(kind, coalition + 1)

    def gained(kind):
        return of(kind, after) - of(kind, F.col("before"))

    without = F.lit(everyone).bitwiseXOR(own)
    return table.select(
        "part", "filter_order", "step", (F.col("total") - of("docs", after)).alias("kept"), gained("docs").alias("removed"),
        (of("docs", own) - gained("docs")).alias("redundant"), (of("docs", F.lit(everyone)) - of("docs", without)).alias("unique_fails"),
        gained("good").alias("good_lost"), gained("toxic").alias("toxic_lost"),
        (of("potential", F.lit(everyone)) - of("potential", without)).alias("shapley"))


def audit_filters(docs: DataFrame, labels: DataFrame, part: Column | None = None, limits: Limits = Limits(),
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The audit of the filters A to E over documents, per part (one part if none is given)."""
    facts = written(document_facts(docs, F.lit("") if part is None else part, limits, id_col, text_col))
    return audit(with_potentials(coalition_worths(mask_counts(with_copies(facts), labels))))
