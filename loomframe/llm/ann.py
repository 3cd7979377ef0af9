"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product becomes smallest distance: points are divided by the largest norm M and get one more component
sqrt(1 - |x/M|^2), queries are brought to length one. Each table projects on Gaussian directions and cuts the line into
cells; a query visits its own bucket and those with some cells moved by one, in the order of their estimated success (the
squared distances to the cells' borders). Candidates of all tables are merged and reranked by the exact inner product of the
original vectors in double precision.

The cell width, the number of probes and of tables are fitted on a bounded sample, by the recall of the neighbours that are
as near in the sample as the wanted ones are among all rows. Every row is indexed.

Equal vectors are hashed and compared once, with their smallest ids (one more than wanted, as a query leaves itself out), so
copies of one vector are no hot bucket; buckets above CHUNK points are split.

Nulls and edge cases: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part, neither as queries nor as candidates; so do rows of null id. Ties go to the smaller id. Repeated rows (equal id and
vector) are one. A query whose buckets held fewer than wanted is compared with all points (as are all queries, if the fit
does not reach LEAST); with fewer candidates than wanted all of them are returned. Very many equal scores are decided by id. An
empty table gives no row. Extra columns are not looked at, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomframe.llm.common import batches_of, col, written
from loomframe.plans.runtime import settle

DIRECTIONS = 4
MOVES = np.array(list(product((-1, 0, 1), repeat=DIRECTIONS)))
# Rows the parameters are fitted on, and the recall wanted there (above the 0.9 wanted of all rows).
SAMPLE, QUERIES, RECALL = 4096, 256, 0.96
# If no width, tables and probes reach this recall on the sample, all points are compared with all queries.
LEAST = 0.9
MOST_TABLES = 12
# Points of a bucket that are searched in one piece; rows of points and queries that meet in one task.
CHUNK, SLOT, QUERY_BLOCK = 4096, 32768, 16384


@dataclass
class Hashing:
    """Directions (tables x components x DIRECTIONS), shifts, cell width, probes per table, the largest norm, and the recall
    on the sample."""

    directions: np.ndarray
    shifts: np.ndarray
    width: float
    probes: int
    norm: float
    recall: float = 0.0

    def points(self, v: np.ndarray) -> np.ndarray:
        x = v / self.norm
        return np.concatenate([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))], axis=1)

    @staticmethod
    def queries(v: np.ndarray) -> np.ndarray:
        return np.concatenate([v / np.linalg.norm(v, axis=1, keepdims=True), np.zeros((len(v), 1))], axis=1)

    def cells(self, x: np.ndarray, table: int) -> np.ndarray:
        return (x @ self.directions[table] + self.shifts[table]) / self.width

    @staticmethod
    def code(cells: np.ndarray) -> np.ndarray:
        return ((cells.astype(np.int64) + 4096) << np.arange(0, 13 * DIRECTIONS, 13)).sum(axis=-1)

    def bucket(self, v: np.ndarray, table: int) -> np.ndarray:
        return self.code(np.floor(self.cells(self.points(v), table)))

    def probed(self, v: np.ndarray, table: int) -> np.ndarray:
        """Buckets that each query visits, the likeliest first."""
        at = self.cells(self.queries(v), table)
        cell = np.floor(at)
        inside = (at - cell)[:, None, :]
        far = np.where(MOVES == 0, 0.0, np.where(MOVES < 0, inside, 1.0 - inside))
        order = np.argsort((far * far).sum(axis=-1), axis=1, kind="stable")[:, : self.probes]
        return self.code(cell[:, None, :] + MOVES[order])


def fit_hashing(sample: np.ndarray, norm: float, rows: int, k: int) -> Hashing:
    """Fit on a sample of vectors out of `rows` for k neighbours."""
    rng = np.random.default_rng(11)
    d = sample.shape[1] + 1
    h = Hashing(rng.normal(size=(MOST_TABLES, d, DIRECTIONS)), rng.uniform(0, 1, size=(MOST_TABLES, 1, DIRECTIONS)), 1.0, len(MOVES), norm)
    x, q = h.points(sample), h.queries(sample[:QUERIES])
    near = q @ x.T
    near[np.arange(len(q)), np.arange(len(q))] = -np.inf
    m = int(np.clip(round(k * len(sample) / max(rows, 1)), 1, max(1, len(sample) - 1)))
    best = np.argsort(-near, axis=1)[:, :m]
    if len(sample) > 1:
        distance = np.sqrt(np.maximum(0.0, 2 - 2 * np.median(np.take_along_axis(near, best, axis=1))))
        h.width = float(max(1e-3, 1.1 * distance))
    h.shifts = h.shifts * h.width
    steps = sorted({1, 3, 9, 16, 24, 32, 48, 64, len(MOVES)})
    found = np.zeros((len(steps), len(q), m), bool)
    for tables in range(1, MOST_TABLES + 1):
        t = tables - 1
        codes, probes = h.bucket(sample, t), h.probed(sample[:QUERIES], t)
        hit = probes[:, :, None] == codes[best][:, None, :]
        for s, n in enumerate(steps):
            found[s] |= hit[:, :n].any(axis=1)
        h.recall = float(found[-1].mean())
        good = [n for s, n in enumerate(steps) if found[s].mean() >= RECALL]
        if tables >= 4 and good:
            h.probes = good[0]
            break
    h.directions, h.shifts = h.directions[:tables], h.shifts[:tables]
    return h


def usable(v: Column) -> Column:
    """Vectors without null or non-finite components that are not zero."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), id and score: each query's k nearest rows found. `queries` tells which rows are queries."""
    spark = vectors.sparkSession
    rows = vectors.select(col(id_col).cast("long").alias("id"), col(vector_col).cast("array<double>").alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("asks")).filter(usable(F.col("v")) & F.col("id").isNotNull())
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).alias("norm"))
    usual = sizes.orderBy(F.desc("n"), "d").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    rows = rows.filter(F.size("v") == usual["d"])
    # distinct vectors with their smallest ids; the row limit per vector is applied before and after the shuffle
    ranked = rows.select("id", "v").distinct().withColumn("r", F.row_number().over(W.partitionBy("v").orderBy("id"))).filter(F.col("r") <= k + 1)
    points = written(ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("point", F.col("ids")[0]))
    n = points.count()
    sample = points.orderBy(F.xxhash64("point"), "point").limit(SAMPLE).select("v").toArrow()
    h = fit_hashing(_matrix(sample.column(0)), float(usual["norm"]), n, k)
    tables = len(h.directions)

    @F.pandas_udf("array<long>")
    def buckets(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()) if len(v) else np.zeros((0, usual["d"]))
        return pd.Series(list(np.stack([h.bucket(x, t) for t in range(tables)], axis=1)))

    @F.pandas_udf("array<array<long>>")
    def probes(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()) if len(v) else np.zeros((0, usual["d"]))
        return pd.Series([list(r) for r in np.stack([h.probed(x, t) for t in range(tables)], axis=1)])

    hashed = written(points.select("point", "v", buckets("v").alias("codes")))
    placed = hashed.select("point", "v", F.posexplode("codes").alias("table", "code"))
    crowded = settle(placed.groupBy("table", "code").count().filter(F.col("count") > CHUNK)
                     .select("table", "code", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))).hinted()
    slots = max(16, -(-n * tables // SLOT))
    chunks = F.coalesce("chunks", F.lit(1))
    bucket = F.xxhash64("table", "code", "chunk")
    slot = F.pmod("bucket", F.lit(slots)).cast("int")

    asked = rows.filter("asks").select(F.col("id").alias("query_id"), "v").distinct()
    askers = written(asked.join(points.select("v", "point"), "v").select("query_id", "point"))
    sought = askers.select("point").distinct()
    sought = points.join(sought, "point", "left_semi").select(F.col("point").alias("query"), "v", probes("v").alias("codes"))
    visits = (sought.select("query", "v", F.posexplode("codes").alias("table", "c")).select("query", "v", "table", F.explode("c").alias("code"))
              .join(crowded, ["table", "code"], "left").withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
              .withColumn("bucket", bucket).groupBy("query", slot.alias("slot")).agg(F.first("v").alias("v"), F.collect_list("bucket").alias("buckets")))
    placed = (placed.join(crowded, ["table", "code"], "left").withColumn("chunk", F.pmod(F.xxhash64("point"), chunks).cast("int"))
              .withColumn("bucket", bucket).select("point", "v", "bucket", slot.alias("slot")))

    fields = pa.schema([("query", pa.int64()), ("point", pa.int64()), ("score", pa.float64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = _search(left, right, k + 1) if left.num_rows and right.num_rows else [[], [], []]
        return pa.Table.from_batches(list(batches_of(fields, found)), schema=fields)

    if h.recall >= LEAST:
        placed, visits = dealt(placed, visits)
        met = (placed.groupBy("slot", "block").cogroup(visits.groupBy("slot", "block"))
               .applyInArrow(search, "query long, point long, score double"))
    else:
        met = spark.createDataFrame([], "query long, point long, score double")
    met = met.groupBy("query", "point").agg(F.max("score").alias("score"))
    ids = points.select("point", "ids")
    best = met.withColumn("r", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "point"))).filter(F.col("r") <= k + 1)
    best = written(best.select("query", "point", "score"))

    def listed(best: DataFrame) -> DataFrame:
        spread = best.join(ids, "point").select("query", "score", F.explode("ids").alias("id"))
        spread = spread.withColumn("r", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "id"))).filter(F.col("r") <= k + 1)
        lists = spread.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))).alias("near"))
        # a query leaves itself out
        near = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
        return askers.join(lists, askers["point"] == lists["query"], "left").select("query_id", "point", F.coalesce(near, F.array()).alias("near"))

    own = listed(best)
    candidates = points.agg(F.sum(F.size("ids")).alias("n")).first()["n"] - 1
    short = written(own.filter(F.size("near") < min(k, candidates)).select("point").distinct())
    few = short.count()
    if few:  # they meet all points, in chunks of CHUNK points
        chunked, parts, per = -(-n // CHUNK), -(-few // QUERY_BLOCK), SLOT // CHUNK
        chunk = F.pmod(F.xxhash64("point"), F.lit(chunked)).alias("bucket")
        everyone = points.select("point", "v", chunk).withColumn("slot", F.floor(F.col("bucket") / per).cast("int")).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        seeking = (points.join(short, "point", "left_semi").select(F.col("point").alias("query"), F.col("v").alias("v"), F.explode(F.sequence(F.lit(0), F.lit((chunked - 1) // per))).alias("slot"))
                   .withColumn("buckets", F.sequence(F.col("slot").cast("long") * per, (F.col("slot").cast("long") + 1) * per - 1))
                   .withColumn("block", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int")))
        exact = (everyone.groupBy("slot", "block").cogroup(seeking.groupBy("slot", "block"))
                 .applyInArrow(search, "query long, point long, score double"))
        exact = exact.withColumn("r", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "point"))).filter(F.col("r") <= k + 1)
        others = best.join(short, best["query"] == short["point"], "left_anti")
        own = listed(others.unionByName(exact.select("query", "point", "score")))
    return own.select("query_id", F.posexplode("near").alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("id"), (-F.col("x.s")).alias("score"))


def dealt(placed: DataFrame, visits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points and queries of each slot with a block. A slot that more than QUERY_BLOCK queries visit has a block for each so
    many of them, and its points go to all of these; other slots' points are not copied. A query visits a bounded number of
    slots, so copies grow with the rows and not with their square."""
    busy = settle(visits.select("query", "slot").groupBy("slot").count().filter(F.col("count") > QUERY_BLOCK)
                  .select("slot", F.ceil(F.col("count") / QUERY_BLOCK).cast("int").alias("blocks"))).hinted()
    blocks = F.coalesce("blocks", F.lit(1))
    copied = placed.join(busy, "slot", "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("blocks")
    shared = visits.join(busy, "slot", "left").withColumn("block", F.pmod(F.xxhash64("query"), blocks).cast("int")).drop("blocks")
    return copied, shared


def _search(left: pa.Table, right: pa.Table, k: int) -> list[np.ndarray]:
    """(query, point, score) of the k best points of each query among the buckets it visits."""
    x, point, bucket = _matrix(left["v"]), left["point"].to_numpy(), left["bucket"].to_numpy()
    q, query = _matrix(right["v"]), right["query"].to_numpy()
    lists = right["buckets"].combine_chunks()
    asked, who = lists.flatten().to_numpy(), np.repeat(np.arange(len(query)), np.diff(lists.offsets.to_numpy()))
    by_bucket, by_ask = np.argsort(bucket, kind="stable"), np.argsort(asked, kind="stable")
    kinds, starts = np.unique(bucket[by_bucket], return_index=True)
    ends = np.append(starts[1:], len(bucket))
    first, last = np.searchsorted(asked[by_ask], kinds, "left"), np.searchsorted(asked[by_ask], kinds, "right")
    found = []
    for s, e, a, b in zip(starts, ends, first, last):
        members = by_bucket[s:e]
        for i in range(a, b, 1024):
            askers = who[by_ask[i:min(b, i + 1024)]]
            scores = q[askers] @ x[members].T
            if len(members) > k:  # all that reach the k-th score, ties included
                bound = np.partition(scores, len(members) - k, axis=1)[:, len(members) - k]
                rows, at = np.nonzero(scores >= (bound - 1e-9 * np.abs(bound))[:, None])
            else:
                rows, at = (i.ravel() for i in np.indices(scores.shape))
            found.append(askers[rows] * len(x) + members[at])
    if not found:
        return [[], [], []]
    who, at = np.divmod(np.unique(np.concatenate(found)), len(x))  # a point may come from more than one table
    score = np.concatenate([(q[who[i:i + 4096]] * x[at[i:i + 4096]]).sum(axis=1) for i in range(0, len(who), 4096)])
    order = np.lexsort((point[at], -score, who))
    who, at, score = who[order], at[order], score[order]
    keep = np.arange(len(who)) - np.searchsorted(who, who, "left") < k
    return [query[who[keep]], point[at[keep]], score[keep]]
