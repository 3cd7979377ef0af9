"""Near-duplicate groups by SimHash: fingerprints that differ in few bits are linked, and links form components.

Only distinct fingerprints are compared, so copies cost nothing. Which of them meet is decided by bit blocks: of four
blocks, three differing bits leave one equal, and of four parts of the other 48 bits again one; the 16 pairs of an equal
block and an equal part are the keys, and every linked pair shares at least one. Where fingerprints meet, a pivot table
holds their Hamming distances to reference fingerprints. By the triangle inequality a pair whose distances to any
reference differ by more than the radius cannot be linked; it is discarded coordinate by coordinate, and survivors are
verified on the 64 bits. (Pivot distances alone cannot decide who meets: one reference halves random pairs, so pairs
would still grow with the square of the corpus.) A search from each fingerprint over those not reached yet gives the
components within a key without listing pairs; one edge per member goes on to the components of the whole corpus.

Nulls and edge cases: a null or empty text, or one of white space, has fingerprint 0 and is linked like any other. Null
doc_ids are ignored when the smallest doc_id is taken; a component of null ids alone has component_id null. Repeated
rows all appear. An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.common import col, columns, fresh, released, written
from loomframe.plans.runtime import settle

RADIUS = 3
SHINGLE = 3
# Bytes of a text that are in Python words at once.
PIECE = 1 << 22
SPACES = b" \t\n\x0b\x0c\r"
REFERENCES = np.array([xxhash.xxh64_intdigest(b"reference %d" % i, 0) for i in range(16)], dtype=np.uint64)


def _pieces(data: bytes):
    """Words of a text, a bounded number of bytes at a time."""
    at = 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in SPACES:
            end += 1
        yield data[at:end].split()
        at = end


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text in UTF-8: a bit is 1 if set in over half of the shingles' XXH64 (seed 42)."""
    ones, n, last = np.zeros(64, np.int64), 0, []
    for words in _pieces(data.lower()):
        words = last + words
        if len(words) >= shingle:
            line = b" ".join(words)
            starts = [0]
            for w in words:
                starts.append(starts[-1] + len(w) + 1)
            digest = xxhash.xxh64_digest
            hashes = b"".join([digest(line[a:b - 1], 42) for a, b in zip(starts, starts[shingle:])])
            ones += np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int32)
            n += len(words) - shingle + 1
        last = words[max(0, len(words) - shingle + 1):]
    if not n and last:
        ones, n = np.unpackbits(np.frombuffer(xxhash.xxh64_digest(b" ".join(last), 42), np.uint8)).astype(np.int64), 1
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The kept columns and `fingerprint`, the 64 bits as a signed long."""
    source = docs.select(*[col(c) for c in keep], F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary").alias("_text"))
    schema = source.drop("_text").schema.add("fingerprint", "long")

    def run(batches):
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch.column(batch.num_columns - 1).to_pylist()]
            found = pa.array(np.array(found, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=[*batch.schema.names[:-1], "fingerprint"])

    return source.mapInArrow(released(run), schema)


def blocks(free: list[int], parts: int) -> list[list[int]]:
    """The bits dealt to so many blocks of nearly equal size."""
    return [free[i * len(free) // parts:(i + 1) * len(free) // parts] for i in range(parts)]


def key_masks(radius: int) -> list[int]:
    """Masks of (block, part of the rest): two fingerprints within the radius agree on at least one."""
    masks = []
    for block in blocks(list(range(64)), radius + 1):
        rest = [b for b in range(64) if b not in block]
        masks += [sum(1 << b for b in [*block, *part]) for part in blocks(rest, radius + 1)]
    return masks


def components_of(fps: np.ndarray, radius: int) -> np.ndarray:
    """The smallest member of each member's component; fps are distinct 64-bit values in ascending order.

    A member is compared with those not reached yet only: first by the pivot table, then bit by bit.
    """
    label = np.arange(len(fps))
    pivots = np.bitwise_count(fps[:, None] ^ REFERENCES[None, :]).astype(np.int16)
    left = np.arange(len(fps))
    while len(left):
        root, todo = left[0], [left[0]]
        left = left[1:]
        while todo and len(left):
            x = todo.pop()
            near = left
            for p in range(pivots.shape[1]):
                near = near[np.abs(pivots[near, p] - pivots[x, p]) <= radius]
                if not len(near):
                    break
            near = near[np.bitwise_count(fps[near] ^ fps[x]) <= radius]
            if len(near):
                label[near] = root
                todo.extend(near.tolist())
                left = left[~np.isin(left, near, assume_unique=True)]
        if not len(left):
            break
    return fps[label]


# A key's members beyond which they are dealt to keys of more equal bits.
CROWD = 20_000


def _edges(fps: np.ndarray, free: list[int], radius: int):
    """(member, smaller member) edges that connect the linked members of one key.

    A crowd is dealt out again by equal parts of its free bits; every linked pair agrees on one of them.
    """
    if len(fps) > CROWD and len(free) > radius:
        for part in blocks(free, radius + 1):
            mask = np.uint64(sum(1 << b for b in part))
            key = fps & mask
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.diff(key[order])) + 1
            rest = [b for b in free if b not in part]
            for members in np.split(fps[order], cuts):
                if len(members) > 1:
                    yield from _edges(members, rest, radius)
        return
    roots = components_of(fps, radius)
    linked = roots != fps
    if linked.any():
        yield fps[linked], roots[linked]


def link_edges(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b), a > b as unsigned bits, that connect all fingerprints within the radius; one column `fingerprint`."""
    masks = key_masks(radius)
    keyed = distinct.select("fingerprint", F.posexplode(F.array(*[
        F.col("fingerprint").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("long")) for m in masks])).alias("tag", "key"))

    def run(batches):
        held, key = [], None

        def flush():
            fps = np.unique(np.concatenate(held)) if held else np.empty(0, np.uint64)
            if len(fps) > 1:
                free = [b for b in range(64) if not masks[key[0]] >> b & 1]
                for a, b in _edges(fps, free, radius):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            tags, keys = (batch.column(i).to_numpy() for i in (0, 1))
            fps = batch.column(2).to_numpy().view(np.uint64)
            cuts = np.flatnonzero((np.diff(tags) != 0) | (np.diff(keys) != 0)) + 1
            starts = [0, *cuts.tolist(), len(fps)]
            for s, e in zip(starts, starts[1:]):
                if s == e:
                    continue
                if key != (tags[s], keys[s]):
                    yield from flush()
                    held, key = [], (int(tags[s]), int(keys[s]))
                held.append(fps[s:e])
        yield from flush()

    return (keyed.select("tag", "key", "fingerprint").repartition("tag", "key").sortWithinPartitions("tag", "key")
            .mapInArrow(released(run), "a long, b long").distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): the root is the smallest node of the component; nodes without an edge are left out.

    Alternating star contraction: each step hangs a node's larger, then its smaller neighbors on the smallest one. Minima
    are partial aggregations, and hubs are joined by key, where adaptive execution splits them.
    """
    def mark(df):
        return df.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()

    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = mark(edges)
    while before["n"]:
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = written(small.select("b", "m").filter("b <> m").union(least.select("a", "m")).toDF("a", "b").distinct())
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicate_map(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, component): the smallest fingerprint (signed) each one reaches. `prints` has a column `fingerprint`."""
    distinct = written(prints.select("fingerprint").distinct())
    roots = connected_components(link_edges(distinct, radius))
    return (distinct.join(roots, distinct["fingerprint"] == roots["node"], "left")
            .select("fingerprint", F.coalesce("root", "fingerprint").alias("component")))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id of all documents reachable by links."""
    prints = written(fingerprints(docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text")), shingle))
    groups = near_duplicate_map(prints, radius)
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    members = written(groups.join(first, "fingerprint"))
    smallest = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    ids = members.join(smallest, "component").select("fingerprint", "component_id")
    return prints.join(ids, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The table with one row of each component: the one of the smallest doc_id (nulls last), then of the smallest text hash.

    Rows of equal id and text count as one document; one of them stays.
    """
    key = F.xxhash64(F.coalesce(col(text_col).cast("string"), F.lit("")))
    rows = docs.select(col(id_col).alias("doc_id"), key.alias("text_hash"), col(text_col).alias("text"))
    prints = written(fingerprints(rows, shingle, ("doc_id", "text_hash")))
    return keep_first(docs, prints, near_duplicate_map(prints, radius), id_col, text_col)


def keep_first(docs: DataFrame, prints: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """keep_one for groups (fingerprint, component) of the documents' prints (doc_id, text_hash, fingerprint)."""
    key = F.xxhash64(F.coalesce(col(text_col).cast("string"), F.lit("")))
    firsts = prints.groupBy("fingerprint").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"))
    kept = groups.join(firsts, "fingerprint").groupBy("component").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    counts = prints.groupBy("doc_id", "text_hash").count()
    counts = written(counts.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left"))
    gone_id, gone_hash, mark = fresh(docs, "_gone_id", "_gone_hash", "_mark")
    names = [F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_hash)]
    match = col(id_col).eqNullSafe(F.col(gone_id)) & (key == F.col(gone_hash))
    # what goes is less than what stays: broadcast if counted to be few
    gone = settle(counts.filter("_hash IS NULL OR count > 1").select(*names)).hinted()
    single = docs.join(gone, match, "left_anti").select(*columns(docs.columns))
    repeated = counts.filter("_hash IS NOT NULL AND count > 1").select(*names)
    if repeated.isEmpty():
        return single
    several = docs.join(settle(repeated).hinted(), match, "left_semi").withColumn(mark, key).dropDuplicates([id_col, mark])
    return single.unionByName(several.select(*columns(docs.columns)))
