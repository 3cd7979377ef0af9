"""Benchmark decontamination: windows of documents that nearly equal a benchmark item, by DataFrame functions only.

Words are runs of letters and digits (all beyond ASCII count as letters) of the lower-cased text, shingles are five
words; an item of fewer words is one shingle. A window has an item's number of words (the whole document if that is
shorter) and its shingles weigh as often as they occur. Steps:

1. Every shingle of every document is looked up among the items' shingles. A window similar to an item shares shingles
   with it, and moved to start at its first shared one it shares no fewer; so windows start at the shingles found, one for
   each length of an item that has it (and are moved back where the document ends).
2. Equal windows of all documents become one. Windows and items get SimHash fingerprints of 64 bits.
3. Multi-index: fingerprints are cut into blocks; within the radius, some block differs in at most radius/blocks bits. Items
   are indexed under each block's value and all values that near, windows look up their blocks: every pair within the
   radius meets.
4. Pairs within the radius are verified by the exact similarity: shared weight over the weight of both together.

Nulls and edge cases: null or empty texts and items without a word match nothing. Items of equal words are one, named by
the smallest item_id. Documents are told apart by doc_id and text; repeated rows give one result. Null doc_ids are kept.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomframe.llm.common import col, columns, fresh, text_of, written
from loomframe.plans.runtime import settle

SHINGLE = 5
SIMILARITY = 0.8
# At a similarity of 0.8, 10 of 64 bits differ on average; one window in a million differs in more than the radius.
RADIUS = 23
BLOCKS = 8
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NO_WORD), "")


def shingles_of(words: Column, width: int) -> Column:
    """Hashes of all runs of `width` words, in order; empty if there are fewer words."""
    run = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)])
    some = F.transform(F.sequence(F.lit(0), F.size(words) - width), run)
    return F.when(F.size(words) >= width, some).otherwise(F.array().cast("array<bigint>"))


def simhash(bag: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprints of bags of shingle hashes (a row per occurrence): a bit is 1 if set in over half of them.

    Bits are counted two to a sum, 32 bits apart. Also `tagged`: the occurrences numbered within equal shingles, so that
    bags can be intersected as sets.
    """
    lanes = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(0x100000001).cast("long"))).alias(f"_l{k}") for k in range(32)]
    nth = F.row_number().over(W.partitionBy(*keys, "h").orderBy("h"))
    tagged = bag.repartition(*keys).withColumn("_tag", F.xxhash64("h", nth))
    summed = tagged.groupBy(*keys).agg(F.count("*").alias("weight"), F.collect_list("_tag").alias("tagged"), *lanes)
    half = F.col("weight")
    low = lambda k: F.col(f"_l{k}").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")) * 2 > half
    high = lambda k: F.shiftrightunsigned(F.col(f"_l{k}"), 32) * 2 > half
    bits = F.lit(0).cast("long")
    for k in range(32):
        bits = bits.bitwiseOR(F.when(low(k), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
        top = 1 << (k + 32)
        bits = bits.bitwiseOR(F.when(high(k), F.lit(top - (1 << 64) if k == 31 else top).cast("long")).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, "weight", "tagged", bits.alias("fingerprint"))


def block_values(fingerprint: Column, blocks: int, flips: int) -> Column:
    """An array of (block, value): each block's value and all values that differ from it in up to `flips` bits."""
    width = 64 // blocks
    patterns = [sum(1 << b for b in bits) for n in range(flips + 1) for bits in combinations(range(width), n)]
    near = F.array(*[F.lit(p).cast("long") for p in patterns])

    def values(i: int) -> Column:
        value = F.shiftrightunsigned(fingerprint, i * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        return F.transform(near, lambda p: F.struct(F.lit(i).alias("block"), value.bitwiseXOR(p).alias("value")))

    return F.flatten(F.array(*[values(i) for i in range(blocks)]))


def benchmark_items(benchmark: DataFrame, shingle: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct items: item_id (the smallest), length in words, width of their shingles, and the shingles."""
    rows = benchmark.select(col(id_col).alias("item_id"), words_of(text_of(text_col)).alias("words")).filter("size(words) > 0")
    rows = rows.groupBy("words").agg(F.min("item_id").alias("item_id")).withColumn("length", F.size("words"))
    width = F.least(F.lit(shingle), F.col("length"))
    parts = F.lit(None).cast("array<bigint>")
    for k in range(1, shingle + 1):
        parts = F.when(width == k, shingles_of(F.col("words"), k)).otherwise(parts)
    return rows.select("item_id", "length", width.alias("width"), parts.alias("shingles"))


def window_starts(width: int, similarity: float) -> Column:
    """Starts of the windows to compare, from the columns n, length and at (the sorted places of shared shingles).

    Similarity s of a window with A shingles to an item with B needs at least s(A+B)/(1+s) places in the window. A window starts
    at a place or, where the document ends too early for that, as late as possible.
    """
    last = F.greatest(F.lit(0), F.col("n") - F.col("length"))
    both = F.least(F.col("n"), F.col("length")) - width + 1 + F.col("length") - width + 1
    need = F.greatest(F.lit(1), F.ceil(both * (similarity / (1 + similarity)) - 1e-9).cast("int"))
    reach = F.col("length") - width
    full = F.transform("at", lambda p, i: F.when((p <= last) & (F.coalesce(F.get(F.col("at"), i + need - 1), F.lit(1 << 30)) <= p + reach), p))
    late = F.when(F.size(F.filter("at", lambda p: p >= last)) >= need, F.array(last)).otherwise(F.array().cast("array<int>"))
    return F.array_union(F.array_compact(full), late)


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS,
                 blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, item_id, start, words and similarity: of each document and item its most similar window
    (the first of equals), if that reaches the similarity. `start` counts words from 0."""
    items = written(benchmark_items(benchmark, shingle))
    # (hash, width, length) of the items' shingles: broadcast only if counted to be small
    index = settle(items.select(F.explode("shingles").alias("h"), "width", "length").distinct()).hinted()
    texts = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    key = ["doc_id", "text_hash"]
    found = None
    for (width,) in items.select("width").distinct().orderBy("width").collect():  # at most `shingle` values
        places = texts.select(*key, words_of(F.col("text")).alias("words")).select(*key, F.size("words").alias("n"), F.posexplode(shingles_of(F.col("words"), width)).alias("at", "h"))
        hits = places.join(index.filter(F.col("width") == width), "h").select(*key, "n", "length", "at").distinct()
        # a document's places for one length, in order; windows with too few of them to be similar are left out
        hits = hits.groupBy(*key, "n", "length").agg(F.array_sort(F.collect_list("at")).alias("at"))
        windows = written(hits.select(*key, "length", F.explode(window_starts(width, similarity)).alias("start"))
                          .groupBy(*key).agg(F.collect_list(F.struct("length", "start")).alias("windows")))
        # texts of these documents only: by broadcast if they are counted to be few
        some = settle(windows.select(F.col("doc_id").alias("some_id"), F.col("text_hash").alias("some_hash"))).hinted()
        again = texts.join(some, F.col("doc_id").eqNullSafe(F.col("some_id")) & (F.col("text_hash") == F.col("some_hash")), "left_semi")
        again = again.select(*key, words_of(F.col("text")).alias("words"))  # a projection of its own: computed once a row
        again = again.select(*key, shingles_of(F.col("words"), width).alias("hs")).dropDuplicates(key)
        same = again["doc_id"].eqNullSafe(windows["doc_id"]) & (again["text_hash"] == windows["text_hash"])
        held = again.join(windows, same).select(again["doc_id"], again["text_hash"], "hs", "windows")
        part = held.select(*key, "hs", F.explode("windows").alias("w")).select(
            *key, F.col("w.length").alias("length"), F.col("w.start").alias("start"),
            F.slice("hs", F.col("w.start") + 1, F.col("w.length") - width + 1).alias("bag"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return texts.select(*key, F.lit(0).cast("long").alias("item_id"), F.lit(0).alias("start"), F.lit(0).alias("words"),
                            F.lit(0.0).alias("similarity")).filter("false")
    found = written(found.withColumn("bag_hash", F.xxhash64("bag")).distinct())
    # every distinct window once
    bags = found.groupBy("length", "bag_hash").agg(F.first("bag").alias("bag"))
    prints = written(simhash(bags.select("length", "bag_hash", F.explode("bag").alias("h")), ["length", "bag_hash"]))
    item_prints = simhash(items.select("item_id", "length", F.explode("shingles").alias("h")), ["item_id", "length"])
    item_prints = settle(item_prints.select("item_id", "length", F.col("fingerprint").alias("item_fingerprint"), F.col("weight").alias("item_weight"),
                                            F.col("tagged").alias("item_tagged"))).hinted()
    entries = item_prints.select("item_id", "length", "item_fingerprint",
                                 F.explode(block_values(F.col("item_fingerprint"), blocks, radius // blocks)).alias("b"))
    entries = settle(entries.select("item_id", "length", "item_fingerprint", "b.block", "b.value")).hinted()
    looked = prints.select("length", "bag_hash", "fingerprint", F.explode(block_values(F.col("fingerprint"), blocks, 0)).alias("b"))
    looked = looked.select("length", "bag_hash", "fingerprint", "b.block", "b.value").join(entries, ["length", "block", "value"])
    differ = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint")))
    candidates = looked.filter(differ <= radius).select("length", "bag_hash", "item_id").distinct()
    shared = F.size(F.array_intersect("tagged", "item_tagged"))
    alike = shared / (F.col("weight") + F.col("item_weight") - shared)
    verified = (candidates.join(prints, ["length", "bag_hash"]).join(item_prints, ["item_id", "length"])
                .select("length", "bag_hash", "item_id", alike.alias("similarity")).filter(F.col("similarity") >= similarity))
    hits = found.select(*key, "length", "start", "bag_hash").join(written(verified), ["length", "bag_hash"])
    best = hits.groupBy(*key, "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "length")).alias("best"))
    return best.select(*key, "item_id", (-F.col("best.back")).alias("start"), F.col("best.length").alias("words"), F.col("best.similarity").alias("similarity"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of the table that hold no window similar to an item."""
    found = contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    bad_id, bad_hash = fresh(docs, "_bad_id", "_bad_hash")
    bad = settle(found.select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash)).distinct()).hinted()
    same = col(id_col).eqNullSafe(F.col(bad_id)) & (F.xxhash64(text_of(text_col)) == F.col(bad_hash))
    return docs.join(bad, same, "left_anti").select(*columns(docs.columns))
