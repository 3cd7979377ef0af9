"""Near copies by the exact similarity of their word shingles: bags of five-word shingles with shared weight of at least 0.8 are linked.

Texts that op5's operator (`simhash_dedup.near_duplicates`) links are linked too, and groups are components of links of both kinds: a text
that repeats a passage 50 or 80 times has the same fingerprint either way, but bags of a similarity of 0.6.

A bag's weight is shared weight over the weight of both together, a shingle weighing as often as it occurs (the nth occurrence
is an element of its own, so bags are sets). Steps:

1. Texts of equal bags are one. A bag's SimHash has 512 bits (`wide_simhash`); it is filed under the values of its surest bits.
   Pairs at 0.8 share about 15 keys; of 150,000 drawn ones none was missed by keys or distances.
2. Where bags share a key, those within a Hamming distance of FAR bits are connected (drawn
   pairs at 0.44 are within it once in 230). First 128 bits drop what is near to nobody, then all 512 decide. A crowded key
   is dealt to pairs of its parts, so that a task holds a bounded number of fingerprints.
3. All bags of a group are compared with its first one, pair by pair in a join, which adaptive execution splits.
4. The distance (one minus similarity) is a metric: bags linked to the first one can be linked to one that is not only if their
   distances to the first differ by at most the limit. Those bags alone are gathered by group and compared with each other.

Nulls and edge cases: a text of fewer than five words is one shingle; those without a word are all equal. Texts of any length
are read in pieces. Other columns, also of the names used here, stay as they are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from loomframe.llm import wide_simhash
from loomframe.llm.common import col, released, written
from loomframe.llm.simhash_dedup import _pieces, connected_components, keep_first, near_duplicates
from loomframe.plans.runtime import settle

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 48, 6
BINS, SKETCH, FAR = BANDS * ROWS, 256, 54
# Members of a key in one part.
CROWD = 20_000
LONGS = pa.list_(pa.int64())
EDGES = np.array([(i << 64) // BINS for i in range(BINS)], np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


NUMBERS = np.random.default_rng(17).integers(0, 1 << 63, BINS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(values: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    v = (values ^ numbers) * MIX
    return (v ^ (v >> np.uint64(29))) * MIX


def bag_of(data: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the text's shingles, each occurrence its own."""
    found, last = [], []
    for words in _pieces(data.lower()):
        words = last + words
        found += [xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle])) for i in range(len(words) - shingle + 1)]
        last = words[max(0, len(words) - shingle + 1):]
    if not found and last:
        found = [xxhash.xxh64_intdigest(b" ".join(last))]
    h = np.sort(np.array(found, np.uint64))
    nth = np.arange(len(h)) - np.searchsorted(h, h, "left")
    return np.sort(h ^ (nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def least_values(bag: np.ndarray) -> np.ndarray:
    """The least hash value of each range; for an empty range that of least rank in an order of the range's own."""
    if not len(bag):
        return np.zeros(BINS, np.uint64)
    at = np.searchsorted(bag, EDGES)
    filled = at < np.append(at[1:], len(bag))
    least = bag[np.minimum(at, len(bag) - 1)]
    empty = np.flatnonzero(~filled)
    for i in range(0, len(empty), 64):
        some = empty[i:i + 64]
        least[some] = bag[mixed(bag[None, :], NUMBERS[some, None]).argmin(axis=1)]
    return least


def keys_of(least: np.ndarray) -> np.ndarray:
    """A key of each band: a hash of its values."""
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(least.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def sketch_of(least: np.ndarray) -> np.ndarray:
    """A bit of each of the first ranges' values, as four longs."""
    return np.packbits((mixed(least, NUMBERS) >> np.uint64(63)).astype(np.uint8)[:SKETCH]).view(np.int64)


def reached(sketches: np.ndarray, far: int = FAR) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, the one it was reached from) that connect all sketches within the distance."""
    return wide_simhash.reached(sketches, far)


def candidate_links(distinct: DataFrame, far: int = FAR, longs: int = SKETCH // 64, keyed: DataFrame | None = None) -> DataFrame:
    """(a, b): edges that connect bags which share a key and have near sketches of so many longs; `distinct` has fingerprint, keys and
    sketch, and `keyed` the (fingerprint, key) that matter, if not all do."""
    keyed = distinct.select("fingerprint", F.explode("keys").alias("key")) if keyed is None else keyed
    crowds = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").withColumn("parts", F.ceil(F.col("n") / CROWD).cast("int"))
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    dealt = keyed.join(crowds, "key").withColumn("part", part).select("fingerprint", "key", "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    dealt = dealt.select("fingerprint", "key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"))
    members = dealt.join(distinct.select("fingerprint", "sketch"), "fingerprint").select("key", "low", "high", "fingerprint", *[F.col("sketch")[i] for i in range(longs)])

    def run(batches):
        held, key = [], None

        def flush():
            rows = np.concatenate(held) if held else np.empty((0, 1 + longs), np.int64)
            if len(rows) > 1:
                a, b = reached(rows[:, 1:], far)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(rows[a, 0]), pa.array(rows[b, 0])], names=["a", "b"])

        for batch in batches:
            names, rows = np.stack([c.to_numpy() for c in batch.columns[:3]], axis=1), np.stack([c.to_numpy() for c in batch.columns[3:]], axis=1)
            cuts = np.flatnonzero((np.diff(names, axis=0) != 0).any(axis=1)) + 1
            starts = [0, *cuts.tolist(), len(rows)]
            for s, e in zip(starts, starts[1:]):
                if s == e:
                    continue
                if key != tuple(names[s]):
                    yield from flush()
                    held, key = [], tuple(names[s])
                held.append(rows[s:e])
        yield from flush()

    return members.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high").mapInArrow(released(run), "a long, b long").distinct()


def links(bags: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Pairs of positions that connect all bags which are similar; bags reached are not compared with each other again."""
    sizes = np.array([len(b) for b in bags])
    left, out = np.ones(len(bags), bool), []

    def index():
        """All values of the bags not reached yet, and whose they are."""
        at = np.flatnonzero(left)
        values, owner = np.concatenate([bags[i] for i in at]), np.repeat(at, sizes[at])
        order = np.argsort(values, kind="stable")
        return values[order], owner[order], len(at)

    values, owner, indexed = index()
    for root in range(len(bags)):
        todo = [root] if left[root] else []
        left[root] = False
        while todo and left.any():
            if 2 * left.sum() <= indexed:  # what is reached is not searched again
                values, owner, indexed = index()
            x = todo.pop()
            lo, hi = np.searchsorted(values, bags[x], "left"), np.searchsorted(values, bags[x], "right")
            shared = np.zeros(len(bags), np.int64)
            for i in range(0, len(lo), 4096):
                n = hi[i:i + 4096] - lo[i:i + 4096]
                at = np.repeat(lo[i:i + 4096] - np.concatenate([[0], n.cumsum()[:-1]]), n) + np.arange(n.sum())
                shared += np.bincount(owner[at], minlength=len(bags))
            near = np.flatnonzero(left & (shared >= similarity * (sizes + sizes[x] - shared) - 1e-9))
            left[near] = False
            out += [(x, int(y)) for y in near]
            todo.extend(near.tolist())
    return out


def simhash_links(prints: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): edges between the bags of texts that op5's operator puts into one component; `prints` has fingerprint and text_hash, `texts`
    text_hash and _text."""
    found = near_duplicates(texts, id_col="text_hash", text_col="_text").filter("doc_id <> component_id").select("doc_id", "component_id").distinct()
    bags = prints.select("text_hash", "fingerprint").distinct()
    of = lambda name: bags.select(F.col("text_hash").alias(f"_{name}"), F.col("fingerprint").alias(name))
    return found.join(of("a"), F.col("doc_id") == F.col("_a")).join(of("b"), F.col("component_id") == F.col("_b")).select("a", "b")


def near_copy_map(prints: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(fingerprint, component) of the distinct bags; `prints` has fingerprint, text_hash, keys and sketch, `texts` text_hash and _text.

    Bags are computed again for the members of candidate groups only, so those of other texts are never stored.
    """
    same = written(simhash_links(prints, texts))
    distinct = written(prints.groupBy("fingerprint").agg(F.min("text_hash").alias("text_hash"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")))
    near = written(wide_simhash.partnered(distinct, CROWD))
    groups = written(connected_components(candidate_links(distinct, wide_simhash.FAR, wide_simhash.LONGS, near)))  # (node, root)
    grouped = groups.select(F.col("node").alias("fingerprint")).unionByName(groups.select(F.col("root").alias("fingerprint"))).distinct()
    grouped = settle(distinct.select("fingerprint", "text_hash").join(grouped, "fingerprint")).hinted()

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = [bag_of(t).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, LONGS)], names=["fingerprint", "bag"])

    bags = texts.join(grouped, "text_hash").select("fingerprint", "_text").dropDuplicates(["fingerprint"])
    bags = written(bags.mapInArrow(released(run), "fingerprint long, bag array<long>"))
    # the distance of each bag to its group's first one
    first = bags.join(groups.select(F.col("root").alias("fingerprint")).distinct(), "fingerprint").select(F.col("fingerprint").alias("root"), F.col("bag").alias("first_bag"))
    shared = F.size(F.array_intersect("bag", "first_bag"))
    alike = shared / (F.size("bag") + F.size("first_bag") - shared)
    members = bags.join(groups.filter("node <> root"), F.col("fingerprint") == F.col("node")).select("fingerprint", "root", "bag")
    told = written(members.join(first, "root").select("fingerprint", "root", (1 - alike).alias("far")))
    limit = 1 - similarity + 1e-9
    direct = told.filter(F.col("far") <= limit).select(F.col("fingerprint").alias("a"), F.col("root").alias("b"))
    # those not linked, and the linked ones that may be near enough to one of them
    apart = told.filter(F.col("far") > limit).groupBy("root").agg(F.min("far").alias("least"))
    rest = told.join(apart, "root").filter(F.col("far") >= F.col("least") - limit).select("fingerprint", "root")
    gathered = bags.join(rest, "fingerprint").select("root", "fingerprint", "bag")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        prints = group["fingerprint"].tolist()
        found = links([np.asarray(b, np.int64) for b in group["bag"]], similarity)
        return pd.DataFrame([(prints[x], prints[y]) for x, y in found], columns=["a", "b"], dtype="int64")

    edges = direct.unionByName(gathered.groupBy("root").applyInPandas(compare, "a long, b long")).unionByName(same)
    roots = connected_components(edges)
    return distinct.select("fingerprint").join(roots, F.col("fingerprint") == F.col("node"), "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("component"))


def keep_one_near_copy(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table with one row of each group of near copies, chosen as simhash_dedup.keep_one does."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    source = docs.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("_text"))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                found = [bag_of(t) for t in part.column(2).to_pylist()]
                prints = pa.array([xxhash.xxh64_intdigest(b.tobytes()) - (1 << 63) for b in found], pa.int64())
                sketches, keys = (pa.array(list(v), LONGS) for v in wide_simhash.sketches_and_keys(found))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), prints, keys, sketches], names=["doc_id", "text_hash", "fingerprint", "keys", "sketch"])

    schema = source.drop("_text").schema.add("fingerprint", "long").add("keys", ArrayType(LongType())).add("sketch", ArrayType(LongType()))
    prints = written(source.mapInArrow(released(run), schema))
    groups = near_copy_map(prints, source.select("text_hash", "_text"), similarity)
    return keep_first(docs, prints.select("doc_id", "text_hash", "fingerprint"), groups, id_col, text_col)
