"""Spelling variants: words that differ by one inserted, deleted or replaced code point, and the frequent form of each.

A word's prefixes are nodes of a trie, its suffixes those of the trie of reversed words. Nodes are numbered, so that one
pair of integers (prefix node, suffix node) stands for a word with a gap between the two:

* a word *skips* position i as the pair of the prefix before i and the suffix after it. Words that skip to the same pair
  are replacements of each other, for they agree in all but that position;
* a word *splits* before position i as the pair of the prefix before i and the suffix from i on. A word that skips to the
  pair of a split holds one code point more, just there. A run of equal code points gives one deletion, so only the first
  of a run counts.

Equal pairs are equal gaps: neighbours are exact and need no check. A pair has at most one splitting word and one skipping
word for each letter, so its rows are few; each word takes the number of its partners and the best of them, and no list of
pairs is made. Words have 2 * length + 1 pairs.

Numbering: words are dealt to sorted ranges. A range keeps one path from the root, and a word's new nodes follow those
shared with the word before, so the work is the sum of the words' lengths. Prefixes of a range's last word may go on in
the next range: they are numbered by the first range whose last word has them, which the last words alone tell (one word
a range, the only thing that passes the driver).

Counts are made per document, summed in a task in a table of bounded size, then by word. Words have the same counts on each run.

Nulls and edge cases: a null or empty text has no words. A null id is the empty string in the check sum. Repeated rows
count each. A run of letters may be of any length; a text is read in pieces cut at white space. Ties go to the
smallest word in code-point order. An empty table gives no row. Other columns of the table are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from math import ceil, log, log2

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomframe.llm.common import col, text_of, written
from loomframe.llm.simhash_dedup import PIECE, SPACES

LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
# One word in so many loses a code point, as if it were misspelt.
SLIPS = 199
# Distinct words that a task sums up before it passes them on.
HELD = 200_000
# Path entries in one Arrow batch.
ENTRIES = 200_000
# Node numbers: the range, whether the node is the range's own, and the place.
RANGE_BITS, OWN = 40, 1 << 39


def pieces(data: bytes):
    """A text in parts of a bounded number of bytes, cut at white space."""
    at = 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and data[end] not in SPACES:
            end += 1
        yield data[at:end].decode("utf-8", "replace")
        at = end


def spelled(data: bytes, key: bytes, least: int = LEAST_LENGTH, slips: int = SLIPS) -> Counter:
    """How often each word of at least so many code points stands in a text in UTF-8, slips included."""
    runs = Counter()
    for piece in pieces(data.lower()):  # bytes: A to Z only
        runs.update(re.findall(rf"[a-zÀ-ÿ]{{{least},}}", piece))
    start, out = zlib.crc32(key), Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % slips == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        out[run] += n
    return out


def word_counts(docs: DataFrame, least: int = LEAST_LENGTH, slips: int = SLIPS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n, its occurrences in all texts."""
    key = F.concat(F.coalesce(col(id_col).cast("string"), F.lit("")), F.lit(":")).cast("binary")
    source = docs.select(key.alias("key"), text_of(text_col).cast("binary").alias("data"))

    def batch(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        held = Counter()
        for rows in batches:
            for key, data in zip(rows.column(0), rows.column(1)):
                for word, n in spelled(data.as_py(), key.as_py(), least, slips).items():
                    held[word] += n
                if len(held) > HELD:
                    yield batch(held)
                    held = Counter()
        yield batch(held)

    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def shared(a: str, b: str) -> int:
    """How many code points two words begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:  # a[:low] is equal, a[:high] is not
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def border_paths(lasts: list[tuple[int, str]]) -> dict[int, tuple[str, list[int]]]:
    """Each range's last word and the nodes of all its prefixes; a node has the number of the first range that ends in it."""
    out, word, path = {}, "", [0]
    for part, last in lasts:
        common = shared(word, last)
        path = path[:common + 1] + [(part + 1) << RANGE_BITS | d for d in range(common + 1, len(last) + 1)]
        word = last
        out[part] = (word, path)
    return out


def numbered(words: DataFrame, key: str) -> DataFrame:
    """`place`, ascending in code-point order of the key, and `path`, the trie nodes of its prefixes from the empty one on.

    Keys are distinct and not null; the other columns stay. `fresh` tells which code points differ from the one before.
    """
    ranges = written(words.repartitionByRange(key).withColumn("part", F.spark_partition_id()))
    lasts = sorted((r["part"], r["last"]) for r in ranges.groupBy("part").agg(F.max(key).alias("last")).collect())
    borders = border_paths(lasts)
    before = {part: borders[lasts[i - 1][0]] if i else ("", [0]) for i, (part, _) in enumerate(lasts)}
    names = ranges.columns
    schema = ", ".join(f"{n} {t}" for n, t in ranges.dtypes) + ", place long, path array<long>, fresh array<boolean>"

    def run(batches):
        part, word, path, own, at, nodes = None, "", [0], None, 0, 0
        for rows in batches:
            parts, keys = rows.column(names.index("part")).to_pylist(), rows.column(names.index(key)).to_pylist()
            start, places, paths, fresh, size = 0, [], [], [], 0
            for i, (p, w) in enumerate(zip(parts, keys)):
                if p != part:
                    part, (word, path), own, at, nodes = p, before[p], borders[p], 0, 0
                depth = shared(word, w) + 1
                path = path[:depth]
                border = shared(own[0], w)
                if depth <= border:
                    path += own[1][depth:border + 1]
                new = len(w) + 1 - len(path)
                path = path + list(range(base := (part + 1) << RANGE_BITS | OWN | nodes, base + new))
                nodes += new
                word = w
                places.append((part + 1) << RANGE_BITS | at)
                paths.append(path)
                fresh.append([True, *[a != b for a, b in zip(w, w[1:])]][:len(w)])
                at, size = at + 1, size + len(path)
                if size > ENTRIES or i == len(keys) - 1:
                    made = [pa.array(places, pa.int64()), pa.array(paths, pa.list_(pa.int64())), pa.array(fresh, pa.list_(pa.bool_()))]
                    yield pa.RecordBatch.from_arrays([*rows.slice(start, i + 1 - start).columns, *made], names=[*names, "place", "path", "fresh"])
                    start, places, paths, fresh, size = i + 1, [], [], [], 0

    return ranges.repartition("part").sortWithinPartitions("part", key).mapInArrow(run, schema).drop("part")


def gap_pairs(words: DataFrame) -> DataFrame:
    """A row per word and gap: prefix, suffix, skips (or splits), first (of a run of equal code points), n and id."""
    length = F.size("path") - 1

    def skip(i):
        return F.struct(F.get("path", i).alias("prefix"), F.get("back", length - 1 - i).alias("suffix"), F.lit(True).alias("skips"), F.get("fresh", i).alias("first"))

    def split(i):
        return F.struct(F.get("path", i).alias("prefix"), F.get("back", length - i).alias("suffix"), F.lit(False).alias("skips"), F.lit(False).alias("first"))

    gaps = F.concat(F.transform(F.sequence(F.lit(0), length - 1), skip), F.transform(F.sequence(F.lit(0), length), split))
    return words.select("id", "n", F.inline(gaps))


def near_words(pairs: DataFrame) -> DataFrame:
    """id, n_near and best (least, id) of the words that have a near word; `least` is the negative count."""
    rank = F.struct((-F.col("n")).alias("least"), "id")
    whole = Window.partitionBy("prefix", "suffix")
    skips, first = F.col("skips"), F.col("first")
    ordered = whole.orderBy(~skips, rank).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = pairs.select(
        "id", "skips", "first", rank.alias("rank"),
        F.count(F.when(skips, 1)).over(whole).alias("n_skips"), F.count(F.when(first, 1)).over(whole).alias("n_first"),
        F.min(F.when(skips, rank)).over(whole).alias("best_skip"), F.min(F.when(first, rank)).over(whole).alias("best_first"),
        F.nth_value(F.when(skips, rank), 2).over(ordered).alias("second_skip"), F.min(F.when(~skips, rank)).over(whole).alias("split"))
    other = F.when(F.col("rank") == F.col("best_skip"), F.col("second_skip")).otherwise(F.col("best_skip"))
    near = F.when(skips, F.col("n_skips") - 1 + F.when(first & F.col("split").isNotNull(), 1).otherwise(0)).otherwise(F.col("n_first"))
    best = F.when(skips, F.least(other, F.when(first, F.col("split")))).otherwise(F.col("best_first"))
    return (table.select("id", near.alias("near"), best.alias("best")).filter("near > 0")
            .groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best")))


def roots_of(forms: DataFrame, rounds: int) -> DataFrame:
    """(id, root): where following (id, form) from word to word ends; each round doubles the steps."""
    roots = forms.select("id", F.col("form").alias("root"))
    for _ in range(rounds):
        ahead = roots.select(F.col("id").alias("root"), F.col("root").alias("ahead"))
        roots = written(roots.join(ahead, "root", "left").select("id", F.coalesce("ahead", "root").alias("root")))
    return roots


def spelling_groups(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES,
                    slips: int = SLIPS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of at least so many code points and occurrences."""
    counts = word_counts(docs, least_length, slips, id_col, text_col).filter(F.col("n") >= least_count)
    words = written(numbered(counts, "word").withColumnRenamed("place", "id"))
    back = numbered(words.select("id", F.reverse("word").alias("reversed")), "reversed").select("id", F.col("path").alias("back"))
    near = written(near_words(gap_pairs(words.join(back, "id"))))
    told = words.select("id", "word", "n")
    forms = near.join(told.select("id", "n"), "id").filter(-F.col("best.least") >= times * F.col("n"))
    forms = written(forms.select("id", F.col("best.id").alias("form"), (-F.col("best.least")).alias("form_n")))
    # each step multiplies the count, so chains are short
    most = told.agg(F.max("n")).first()[0] or least_count
    steps = max(1, int(log(most / least_count, times) + 1e-9)) if most > least_count else 1
    roots = roots_of(forms, ceil(log2(steps)))
    named = forms.join(roots, "id")
    for name in ("form", "root"):
        named = named.withColumnRenamed(name, "at").join(told.select(F.col("id").alias("at"), F.col("word").alias(name)), "at").drop("at")
    out = told.join(near.select("id", "n_near"), "id", "left").join(named, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
