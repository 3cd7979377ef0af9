"""License scan by ordered signature rules, by DataFrame functions only and without a shuffle.

A text that holds none of the gate words is not searched further; of the others, each rule is tried only where one of its
keywords occurs. All matches are sorted by start (the longer, then the higher priority first), and a detection is suppressed if it
lies within another one of the same or a higher priority. Detections that overlap otherwise all stay.

Nulls and edge cases: a null text is empty and has no word and no detection. Null ids and repeated rows are kept, an empty table
gives none. Very long texts are read whole; places are added up in blocks, so a text with very many matches costs time in proportion to
them. Extra columns stay out of the result unless they are named in `keep`, and may have any name.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import ascii_lower, col, columns, fresh, text_of
from loomframe.llm.license_rules import GATES, rules

# Words over ASCII-lower-cased text; the second form also takes capitals, to count without lowering.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Phrases whose places are always reported.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# How sure a detection is, by priority.
CONFIDENCE = {1: 0.95, 2: 0.8, 3: 0.5}

KNOWN = "array<struct<number:int,label:string,priority:int,keywords:array<string>,pattern:string>>"
# Elements that a running total adds up one by one; blocks of them are added up as blocks.
BLOCK = 32


def let(value: Column, use) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, zero: Column, add, levels: int = 2) -> Column:
    """What comes before each element, added up from `zero`. `aggregate` copies its state at every step, so no state holds an
    array: elements are added up within blocks, and blocks as elements of a shorter array."""
    total = lambda a, start: F.aggregate(a, start, add)
    if not levels:
        return let(values, lambda v: F.transform(v, lambda x, i: total(F.slice(v, 1, i), zero)))

    def blocked(v):
        last = F.floor((F.size(v) - 1) / BLOCK).cast("int")
        blocks = F.when(F.size(v) > 0, F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(v, k * BLOCK + 1, BLOCK))).otherwise(F.array(v))
        return let(blocks, lambda bs: F.flatten(F.zip_with(
            bs, running(F.transform(bs, lambda b: total(b, zero)), zero, add, levels - 1),
            lambda b, before: F.transform(b, lambda x, i: total(F.slice(b, 1, i), before)))))

    return let(values, blocked)


def spans_of(text: Column, rule: Column) -> Column:
    """All matches of a rule: texts between matches and matches, laid end to end, give the places."""
    parts = F.zip_with(F.split(text, rule["pattern"]), F.regexp_extract_all(text, rule["pattern"], F.lit(0)),
                       lambda gap, found: F.struct(F.length(gap).alias("gap"), F.length(found).alias("size")))

    def placed(p):
        before = running(F.transform(p, lambda x: x["gap"] + F.coalesce(x["size"], F.lit(0))), F.lit(0), lambda a, b: a + b)
        spans = F.zip_with(p, before, lambda x, at: F.when(x["size"].isNotNull(), F.struct(
            (at + x["gap"]).alias("start"), (-(at + x["gap"] + x["size"])).alias("back"), rule["priority"].alias("priority"),
            rule["number"].alias("rule"), rule["label"].alias("label"))))
        return F.filter(spans, lambda x: x.isNotNull())

    return let(parts, placed)


def unsuppressed(spans: Column) -> Column:
    """Sorted spans without those within an earlier one of the same or a higher priority."""

    def kept(s):
        reached = F.create_map(*[x for p in sorted(CONFIDENCE) for x in (F.lit(p), running(
            F.transform(s, lambda x: F.when(x["priority"] <= p, -x["back"]).otherwise(F.lit(-1))), F.lit(-1), lambda a, b: F.greatest(a, b)))])
        return let(reached, lambda r: F.filter(s, lambda x, i: F.get(F.element_at(r, x["priority"]), i) < -x["back"]))

    return let(F.array_sort(spans), kept)


def scan_licenses(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and n_words, base (places of the base phrases: start in words, label) and detections (start and end
    in characters, priority, rule, label), in order of their start."""
    text, low, words, gated = fresh(docs, "_text", "_low", "_words", "_gated")
    names = ("n_words", "base", "detections")
    # as one literal, which the optimizer reads once
    known = F.from_json(F.lit(json.dumps([{"number": r.number, "label": r.label, "priority": r.priority, "keywords": list(r.keywords), "pattern": r.pattern}
                                          for r in rules()])), KNOWN)
    # one pass over every text: words, and whether any gate word occurs (in any case)
    rows = docs.select(*columns(keep), text_of(text_col).alias(text)).withColumn(low, F.lower(text))
    gate = F.lit(False)
    for g in GATES:
        gate = gate | F.contains(F.col(low), F.lit(g))
    rows = rows.select(*columns(keep), F.regexp_count(F.col(text), F.lit(ANY_WORD)).cast("long").alias(names[0]), F.col(text), gate.alias(gated))
    rows = rows.withColumn(low, F.when(F.col(gated), ascii_lower(F.col(text))))
    rows = rows.withColumn(words, F.when(F.contains(F.col(low), F.lit("license")), F.regexp_extract_all(F.col(low), F.lit(WORD), F.lit(0))))

    def phrase(x, i):
        label = F.lit(None).cast("string")
        for p, name in BASE.items():
            first, *rest = p.split()
            here = x == first
            for k, w in enumerate(rest, 1):
                here = here & (F.get(F.col(words), i + k) == w)
            label = F.when(here, name).otherwise(label)
        return F.struct(i.cast("long").alias("start"), label.alias("label"))

    base = F.filter(F.transform(F.col(words), phrase), lambda b: b["label"].isNotNull())
    tried = F.filter(known, lambda r: F.exists(r["keywords"], lambda k: F.contains(F.col(low), k)))
    spans = F.flatten(F.transform(tried, lambda r: spans_of(F.col(low), r)))
    kept = F.transform(unsuppressed(spans), lambda s: F.struct(s["start"].alias("start"), (-s["back"]).alias("end"), s["priority"].alias("priority"),
                                                               s["rule"].alias("rule"), s["label"].alias("label")))
    none = lambda kind: F.array().cast(kind)
    return rows.select(*columns(keep), names[0], F.coalesce(base, none("array<struct<start:bigint,label:string>>")).alias(names[1]),
                       F.when(F.col(gated), kept).otherwise(none("array<struct<start:int,end:int,priority:int,rule:int,label:string>>")).alias(names[2]))


def label_list(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
