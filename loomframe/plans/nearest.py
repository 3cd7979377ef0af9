"""Exact k-nearest-neighbor join.

Four plans give the same rows:
  * points fit a size-checked broadcast: each query partition finds its neighbors alone, no shuffle of pairs;
  * queries fit: each point partition keeps the k best per query, the partial lists are merged;
  * neither fits, in more than FEW dimensions: no group of points can be left out, so packed blocks of queries meet packed blocks of
    points; a task holds one block of queries and their k best so far, and points stream past them;
  * neither fits, in few dimensions: a vector-approximation file. Every point is rounded to one byte per dimension, and the exact length of
    its rounding error is kept with the code. The distance to a rounded point, less or plus that error, bounds the true
    distance from both sides. Codes and queries meet in blocks of bounded size; pairs whose lower bound is above
    the query's k-th smallest upper bound cannot be neighbors. Full vectors are fetched for the survivors alone, a small
    multiple of k per query also in many dimensions, and their distances are computed exactly. Codes are grouped around
    pivots, so that the triangle inequality keeps queries away from most groups. Of equal points only as many as can be
    neighbors are kept.
Rows that leave a task are a small multiple of k per query in any of them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomframe.plans.runtime import BLOCK_ROWS, BROADCAST_ROWS, cut_lineage, limit_of, stored

BROADCAST_VALUES = 32_000_000  # at most 256 MB of doubles in a broadcast matrix
CHUNK = 4_000_000
MASKED_PAIRS = 1_000_000_000  # above, masked queries are searched pattern by pattern, if there are
PATTERNS = 32  # at most so many; each is a search of its own
PIVOT_VALUES = 4_000_000  # at most 32 MB of doubles in the broadcast table of pivots
LEVELS = 256  # values of a dimension that one byte tells
FEW = 16  # dimensions in which groups of points can be left out
LEAF = 256  # the same in few dimensions, where they are near each other
TILE = 2_048  # points that meet queries at once
PIECE_VALUES = 131_072  # at most 1 MB of doubles in a packed row
QUERY_VALUES = 4_000_000  # at most 32 MB of doubles in the queries that a task holds
SAMPLE = 4_096  # points that place the levels; they decide how tight bounds are, not whether they hold


def matrix_of(column) -> np.ndarray:
    """Arrow list column -> 2-D array of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(n, -1)


def _exact(q: np.ndarray, p: np.ndarray, rows: np.ndarray, cols: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
    out = np.empty(len(rows))
    step = max(1, CHUNK // max(q.shape[1], 1))
    for s in range(0, len(rows), step):
        d = q[rows[s:s + step]] - p[cols[s:s + step]]
        if seen is not None:
            d *= seen[rows[s:s + step]]
        out[s:s + step] = np.sqrt((d * d).sum(axis=1))
    return out


def near_each_other(p: np.ndarray, size: int) -> list[np.ndarray]:
    """Positions of all points: first some from everywhere, then the others in parts of at most `size`, each split at its widest side."""
    parts, todo = [], [np.arange(len(p))]
    while todo:
        some = todo.pop()
        if len(some) <= size:
            parts.append(some)
            continue
        x = p[some]
        x = np.where(np.isfinite(x), x, 0.0)
        order = np.argpartition(x[:, (x.max(axis=0) - x.min(axis=0)).argmax()], len(some) // 2)
        todo += [some[order[len(some) // 2:]], some[order[:len(some) // 2]]]
    if len(parts) == 1:
        return parts
    spread = max(1, len(parts) // size)
    return [np.concatenate([x[:1] for x in parts[::spread]]), *[x[1:] if i % spread == 0 else x for i, x in enumerate(parts)]]


class Best:
    """The k nearest points so far of each query, ties by the points' ids.

    A matrix product, of single precision in many dimensions, tells which points may be nearer than the k-th so far, with a margin for
    its rounding error; their order is decided by distances computed directly.
    """

    def __init__(self, q: np.ndarray, k: int, own: np.ndarray | None = None):
        """`own`: per query the id of the point that does not count."""
        self.q, self.k, self.own = q, k, own
        finite = q[np.isfinite(q).all(axis=1)]
        self.center = finite.mean(axis=0) if len(finite) else np.zeros(q.shape[1])
        moved = q - self.center
        wide = q.shape[1] > FEW and len(finite) and np.abs(finite - self.center).max() < 1e15
        self.kind = np.float32 if wide else np.float64
        self.slack = 4 * (q.shape[1] + 8) * float(np.finfo(self.kind).eps)
        self.q2 = (moved * moved).sum(axis=1)
        self.left = np.column_stack([-2.0 * moved, np.ones(len(q))]).astype(self.kind)
        self.dist, self.ids = np.full((len(q), k), np.inf), None

    def meet(self, p: np.ndarray, ids: np.ndarray) -> None:
        if self.q.shape[1] > FEW:
            for s in range(0, len(p), TILE):
                self._tile(p[s:s + TILE], ids[s:s + TILE])
        else:
            for some in near_each_other(p, LEAF):
                self._tile(p[some], ids[some])

    def _tile(self, p: np.ndarray, ids: np.ndarray) -> None:
        if self.ids is None:
            self.ids = np.empty(self.dist.shape, ids.dtype)
        usable = np.isfinite(p).all(axis=1)
        p, ids = p[usable], ids[usable]
        if not len(p):
            return
        moved = p - self.center
        p2 = (moved * moved).sum(axis=1)
        kind = self.kind if p2.max() < 1e30 else np.float64
        right = np.column_stack([moved, p2]).astype(kind).T
        reach = self._reach(p)
        if not len(reach):
            return
        want = self.k if self.own is None else self.k + int(pd.Series(ids).value_counts().iloc[0])
        step = max(1, CHUNK // len(p))
        for s in range(0, len(reach), step):
            rows = reach[s:s + step]
            near = self.left[rows].astype(kind, copy=False) @ right  # squared distances less the query's square
            q2, kth = self.q2[rows], self.dist[rows, -1]
            margin = self.slack * (q2 + p2.max()) + 1e-30
            limit = kth * kth + margin - q2
            full = np.isfinite(kth)
            if want < len(p):
                if not full.all():
                    limit[~full] = np.partition(near[~full], want - 1, axis=1)[:, want - 1].astype(float) + 2 * margin[~full]
                elif np.count_nonzero(near[:16] <= limit[:16, None]) > 16 * 4 * want:
                    limit = np.minimum(limit, np.partition(near, want - 1, axis=1)[:, want - 1].astype(float) + 2 * margin)
            at = np.flatnonzero(near <= limit.astype(kind)[:, None])
            self._take(rows[at // len(p)], at % len(p), p, ids)

    def _reach(self, p: np.ndarray) -> np.ndarray:
        """The queries that may have one of their k nearest among these points: in few dimensions those near the points' box."""
        if self.q.shape[1] > FEW or not np.isfinite(self.dist[:, -1]).any():
            return np.arange(len(self.q))
        low, high, apart = p.min(axis=0), p.max(axis=0), np.zeros(len(self.q))
        for i in range(self.q.shape[1]):
            gap = np.maximum(np.maximum(low[i] - self.q[:, i], self.q[:, i] - high[i]), 0)
            apart += gap * gap
        return np.flatnonzero(np.sqrt(apart) <= self.dist[:, -1] * (1 + 1e-9))

    def _take(self, rows: np.ndarray, cols: np.ndarray, p: np.ndarray, ids: np.ndarray) -> None:
        """Put points (cols) among the k best of queries (rows)."""
        dist = _exact(self.q, p, rows, cols)
        use = np.isfinite(dist) & (dist <= self.dist[rows, -1])
        if self.own is not None:
            use &= np.asarray(ids[cols] != self.own[rows], bool)
        rows, dist, found = rows[use], dist[use], ids[cols[use]]
        if not len(rows):
            return
        changed = np.unique(rows)
        old = np.isfinite(self.dist[changed])
        rows = np.concatenate([np.repeat(changed, old.sum(axis=1)), rows])
        dist = np.concatenate([self.dist[changed][old], dist])
        found = np.concatenate([self.ids[changed][old], found])
        order = np.lexsort((found if found.dtype != object else pd.factorize(found, sort=True)[0], dist, rows))
        rows, dist, found = rows[order], dist[order], found[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = rank < self.k
        rows, rank = rows[kept], rank[kept]
        self.dist[rows, rank], self.ids[rows, rank] = dist[kept], found[kept]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, id, distance, rank) of all that were found, by row and rank."""
        rows, rank = np.nonzero(np.isfinite(self.dist))
        ids = np.empty(0, int) if self.ids is None else self.ids[rows, rank]
        return rows, ids, self.dist[rows, rank], rank + 1


def top_k(q: np.ndarray, p: np.ndarray, k: int, skip: np.ndarray | None = None, masked: bool = False):
    """(row, column, distance, rank) of the k nearest p of each q, ties by the order of p.

    Masked rows of q hold NaN where they have no value: their distances are over the values they have.
    """
    if masked:
        return _masked_top_k(q, p, k, skip)
    best = Best(q, min(k, max(len(p), 1)), skip)
    best.meet(p, np.arange(len(p)))
    return best.rows()


def _masked_top_k(q: np.ndarray, p: np.ndarray, k: int, skip: np.ndarray | None):
    """Distances over the values of q: a product of q with p, and one of the masks with the squares of p."""
    parts = []
    seen = (~np.isnan(q)).astype(float)
    q = np.where(np.isnan(q), 0.0, q)
    p2 = (p * p).sum(axis=1)
    margin_base = 1e-9 * (1.0 + (p2.max() if len(p2) else 0.0))
    step = max(1, CHUNK // max(len(p), 1))
    for s in range(0, len(q), step):
        qs = q[s:s + step]
        q2 = (qs * qs).sum(axis=1)
        own_p2 = seen[s:s + step] @ (p * p).T
        d2 = q2[:, None] + own_p2 - 2.0 * (qs @ p.T)
        if skip is not None:
            own = skip[s:s + step]
            hit = np.nonzero(own >= 0)[0]
            d2[hit, own[hit]] = np.inf
        if k < d2.shape[1]:
            kth = np.partition(d2, k - 1, axis=1)[:, k - 1]
            mask = d2 <= (kth + margin_base + 1e-9 * q2)[:, None]
        else:
            mask = np.ones(d2.shape, dtype=bool)
        mask &= np.isfinite(d2)
        rows, cols = np.nonzero(mask)
        dist = _exact(qs, p, rows, cols, seen[s:s + step])
        order = np.lexsort((cols, dist, rows))
        rows, cols, dist = rows[order], cols[order], dist[order]
        starts = np.searchsorted(rows, np.arange(len(qs)))
        rank = np.arange(len(rows)) - starts[rows]
        keep = rank < k
        parts.append((rows[keep] + s, cols[keep], dist[keep], rank[keep] + 1))
    if not parts:
        return (np.zeros(0, int),) * 2 + (np.zeros(0),) + (np.zeros(0, int),)
    return tuple(np.concatenate(x) for x in zip(*parts))


def local_matrix(df: DataFrame, id_col: str, n: int | None = None):
    """Ids and vectors on the driver if they are small enough to broadcast, else None."""
    limit = limit_of(df.sparkSession, BROADCAST_ROWS)
    if n is not None and n > limit:
        return None
    first = df.select(F.size("vec").alias("d")).first()
    if first is None:
        return None
    limit = min(limit, BROADCAST_VALUES // max(first["d"], 1))
    rows = df.select(id_col, "vec").limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        return None
    ids = rows.column(id_col).to_pandas()
    order = np.argsort(ids.to_numpy(), kind="stable")
    return ids.to_numpy()[order], matrix_of(rows.column("vec"))[order]


def spread(df: DataFrame, key: str, n: int) -> DataFrame:
    """Enough partitions for a compute-heavy stage: all cores, and at most blockRows rows each."""
    context = df.sparkSession.sparkContext
    block = limit_of(df.sparkSession, BLOCK_ROWS)
    return df.repartition(max(min(context.defaultParallelism, -(-n // 64)), -(-n // block), 1), key)


def _schema(queries: DataFrame, points: DataFrame) -> str:
    q = queries.schema["query_id"].dataType.simpleString()
    p = points.schema["point_id"].dataType.simpleString()
    return f"query_id {q}, point_id {p}, distance double, rank int"


def _merge(partial: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy("distance", "point_id")
    return partial.drop("rank").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def knn_join(queries: DataFrame, points: DataFrame, k: int, metric: str = "euclidean",
             exclude_self: bool = False, n_queries: int | None = None, n_points: int | None = None,
             masked: bool = False) -> DataFrame:
    """Rows (query_id, point_id, distance, rank 1..k) for queries (query_id, vec) and points (point_id, vec).

    Masked queries may hold NULL values; each one's distances are over the values it has.
    """
    if metric != "euclidean":
        raise ValueError(f"unsupported metric {metric!r}")
    queries = queries.select("query_id", F.col("vec").cast("array<double>").alias("vec"))
    points = points.select("point_id", F.col("vec").cast("array<double>").alias("vec"))
    n_points = points.count() if n_points is None else n_points
    if k > n_points - (1 if exclude_self else 0):
        raise ValueError(f"k={k} is larger than the number of points")
    n_queries = queries.count() if n_queries is None else n_queries
    schema = _schema(queries, points)
    if masked and n_queries * n_points > MASKED_PAIRS:
        return _by_pattern(queries, points, k, exclude_self, schema, n_queries, n_points)
    return _unlike(queries, points, k, exclude_self, n_queries, n_points, schema, masked)


def _unlike(queries, points, k, exclude_self, n_queries, n_points, schema, masked=False):
    """The plan for the sizes of both tables."""
    local = local_matrix(points, "point_id", n_points)
    if local is not None:
        return _points_broadcast(queries, local, k, exclude_self, n_queries, schema, masked)
    local = local_matrix(queries, "query_id", n_queries)
    if local is not None:
        return _merge(_queries_broadcast(points, local, k, exclude_self, schema, masked), k)
    if masked:  # the nearest by some values need not be near by all, so no group of points can be left out
        return _merge(_block_join(queries, points, k, exclude_self, n_queries, n_points, schema), k)
    first = points.select(F.size("vec").alias("d")).first()
    if first["d"] > FEW:
        return _merge(_tiles(queries, points, k, exclude_self, n_queries, n_points, schema), k)
    return _merge(_measured(survivors(queries, points, k, exclude_self, n_points), queries, points, schema), k)


def _points_broadcast(queries, local, k, exclude_self, n_queries, schema, masked=False):
    shared = queries.sparkSession.sparkContext.broadcast(local)

    def search(batches):
        ids, p = shared.value
        index = pd.Index(ids)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            q = matrix_of(batch.column(1))
            own = index.get_indexer(batch.column(0).to_pandas()) if exclude_self else None
            rows, cols, dist, rank = top_k(q, p, k, own, masked)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(ids[cols]), pa.array(dist),
                 pa.array(rank.astype("int32"))],
                names=["query_id", "point_id", "distance", "rank"])

    return spread(queries, "query_id", n_queries).mapInArrow(search, schema)


def _queries_broadcast(points, local, k, exclude_self, schema, masked=False):
    shared = points.sparkSession.sparkContext.broadcast(local)

    def search(batches):
        qids, q = shared.value
        best, parts = None if masked else Best(q, k, qids if exclude_self else None), []
        kind = pa.null()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            kind = batch.schema.field(0).type
            ids, p = batch.column(0).to_pandas().to_numpy(), matrix_of(batch.column(1))
            if not masked:
                best.meet(p, ids)
                continue
            order = np.argsort(ids, kind="stable")
            ids, p = ids[order], p[order]
            own = pd.Index(ids).get_indexer(pd.Index(qids)) if exclude_self else None
            rows, cols, dist, _ = top_k(q, p, k, own, masked)
            parts.append(pd.DataFrame({"row": rows, "point_id": ids[cols], "distance": dist}))
            parts = [pd.concat(parts).sort_values(["row", "distance", "point_id"]).groupby("row", sort=False).head(k)]
        if masked:
            at, near, dist = (parts[0][c].to_numpy() for c in ("row", "point_id", "distance")) if parts else ((),) * 3
        else:
            at, near, dist, _ = best.rows()
        for s in range(0, len(at), 100_000):
            part = slice(s, s + 100_000)
            yield pa.RecordBatch.from_pandas(pd.DataFrame({
                "query_id": qids[at[part]], "point_id": pa.array(near[part], kind).to_pandas(), "distance": dist[part],
                "rank": np.ones(len(at[part]), dtype="int32")}), preserve_index=False)

    return points.mapInArrow(search, schema)


def _by_pattern(queries, points, k, exclude_self, schema, n_queries, n_points):
    """Masked queries by the values they have: each pattern is a join over those alone, of distinct queries and distinct points.

    Equal queries have the same neighbors, and of points equal in these values only the k of the smallest ids can be neighbors. With
    very many patterns, or if a query's own point is left out, all are searched in one join.
    """
    known = queries.withColumn("_known", F.transform("vec", lambda v: v.isNotNull()))
    patterns = [r[0] for r in known.select("_known").distinct().limit(PATTERNS + 1).collect()]
    if exclude_self or len(patterns) > PATTERNS:
        return _unlike(queries, points, k, exclude_self, n_queries, n_points, schema, masked=True)
    out = None
    for pattern in patterns:
        places = [i for i, here in enumerate(pattern) if here]
        seen = F.array(*[F.get("vec", F.lit(i)) for i in places]).cast("array<double>")
        mine = cut_lineage(known.filter(F.col("_known") == F.array(*[F.lit(x) for x in pattern])).select("query_id", seen.alias("vec")))
        asks = cut_lineage(mine.groupBy("vec").agg(F.min("query_id").alias("query_id")).select("query_id", "vec"))
        first = Window.partitionBy("vec").orderBy("point_id")
        told = points.select("point_id", seen.alias("vec")).withColumn("_i", F.row_number().over(first))
        told = cut_lineage(told.filter(F.col("_i") <= k).drop("_i"))
        near = _unlike(asks, told, k, False, asks.count(), told.count(), schema)
        near = near.join(asks.withColumnRenamed("query_id", "_ask"), F.col("query_id") == F.col("_ask")).drop("query_id", "_ask")
        near = mine.join(near, "vec").select("query_id", "point_id", "distance", "rank")
        out = near if out is None else out.unionByName(near)
    return out


def _block_join(queries, points, k, exclude_self, n_queries, n_points, schema):
    """Every block of masked queries meets every block of points; k rows per query leave a block."""
    block = limit_of(queries.sparkSession, BLOCK_ROWS)
    q_blocks, p_blocks = max(1, -(-n_queries // block)), max(1, -(-n_points // block))
    qs = (queries.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)))
          .withColumn("pb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(p_blocks - 1).cast("long")))))
    pts = (points.withColumn("pb", F.pmod(F.xxhash64("point_id"), F.lit(p_blocks)))
           .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long")))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "point_id": [], "distance": [], "rank": []})
        right = right.sort_values("point_id")
        ids = right["point_id"].to_numpy()
        own = pd.Index(ids).get_indexer(left["query_id"]) if exclude_self else None
        q = np.array([[np.nan if v is None else v for v in row] for row in left["vec"]], dtype=float)
        rows, cols, dist, rank = top_k(q, np.stack(right["vec"]), k, own, masked=True)
        return pd.DataFrame({"query_id": left["query_id"].to_numpy()[rows], "point_id": ids[cols], "distance": dist, "rank": rank.astype("int32")})

    return qs.groupBy("qb", "pb").cogroup(pts.groupBy("qb", "pb")).applyInPandas(search, schema)


def _pack(block: pa.Table) -> pa.Table:
    """A block as one row: its ids and its vectors as the bytes of a matrix."""
    return pa.table({"piece": block["piece"].slice(0, 1), "ids": pa.array([block["id"].to_pylist()], pa.list_(block["id"].type)),
                     "matrix": pa.array([matrix_of(block["vec"]).tobytes()], pa.binary())})


def _packed(df: DataFrame, id_col: str, n_pieces: int) -> DataFrame:
    """(piece, ids, matrix): the rows dealt to pieces by their ids."""
    kind = df.schema[id_col].dataType.simpleString()
    dealt = df.filter(F.col(id_col).isNotNull()).select(
        F.pmod(F.xxhash64(id_col), F.lit(n_pieces)).cast("int").alias("piece"), F.col(id_col).alias("id"), "vec")
    return stored(dealt.groupBy("piece").applyInArrow(_pack, f"piece int, ids array<{kind}>, matrix binary"))


def _tiles(queries, points, k, exclude_self, n_queries, n_points, schema):
    """Every block of queries meets every group of packed points; k rows per query leave a meeting.

    A task holds the queries of one meeting and their k best; the points come one packed row after another.
    """
    spark = queries.sparkSession
    d = max(1, points.select(F.size("vec").alias("d")).first()["d"])
    rows = max(1, min(limit_of(spark, BLOCK_ROWS), PIECE_VALUES // d))
    meetings = 4 * spark.sparkContext.defaultParallelism
    q_blocks = max(-(-n_queries * d // QUERY_VALUES), min(math.isqrt(meetings) + 1, -(-n_queries // rows)))
    groups = max(1, min(-(-meetings // q_blocks), -(-n_points // rows)))
    # pieces of queries are dealt to blocks by their numbers, those of points to groups
    qs = _packed(queries, "query_id", q_blocks * max(1, -(-n_queries // (rows * q_blocks))))
    pts = _packed(points, "point_id", groups * max(1, -(-n_points // (rows * groups))))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = lambda df: F.lit(None).cast(df.schema["ids"].dataType)
    asks = qs.select((F.col("piece") % q_blocks).alias("qb"), every(groups).alias("pg"), F.lit(0).alias("side"), "piece",
                     F.col("ids").alias("query_ids"), none(pts).alias("point_ids"), "matrix")
    told = pts.select(every(q_blocks).alias("qb"), (F.col("piece") % groups).alias("pg"), F.lit(1).alias("side"), "piece",
                      none(qs).alias("query_ids"), F.col("ids").alias("point_ids"), "matrix")

    def search(batches):
        now, best, ids, held, kind = None, None, None, [], None

        def found():
            if best is not None:
                at, near, dist, rank = best.rows()
                for s in range(0, len(at), 100_000):
                    part = slice(s, s + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at[part])), pa.array(near[part], kind), pa.array(dist[part]), pa.array(rank[part].astype("int32"))],
                        names=["query_id", "point_id", "distance", "rank"])

        for batch in batches:
            kind = batch.schema.field(5).type.value_type
            for i in range(batch.num_rows):
                qb, pg, side = (batch.column(c)[i].as_py() for c in range(3))
                matrix = np.frombuffer(batch.column(6)[i].as_buffer(), np.float64).reshape(-1, d)
                if (qb, pg) != now:
                    yield from found()
                    now, best, held = (qb, pg), None, []
                if side == 0:
                    held.append((batch.column(4)[i].values, matrix))
                elif held:
                    if best is None:
                        ids = pa.concat_arrays([x[0] for x in held])
                        best = Best(np.concatenate([x[1] for x in held]), k, ids.to_numpy(zero_copy_only=False) if exclude_self else None)
                    best.meet(matrix, batch.column(5)[i].values.to_numpy(zero_copy_only=False))
        yield from found()

    met = asks.unionByName(told).repartition(q_blocks * groups, "qb", "pg").sortWithinPartitions("qb", "pg", "side", "piece")
    return met.mapInArrow(search, schema)


def levels_of(sample: np.ndarray) -> np.ndarray:
    """LEVELS values per dimension, a row each, at equal shares of the sample."""
    return np.quantile(sample, (np.arange(LEVELS) + 0.5) / LEVELS, axis=0).T.copy()


def encode(vectors: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte per dimension and the length of what the code leaves out."""
    codes = np.empty(vectors.shape, np.uint8)
    for d in range(vectors.shape[1]):
        codes[:, d] = np.searchsorted((levels[d, 1:] + levels[d, :-1]) / 2, vectors[:, d])
    error = vectors - decode(codes, levels)
    return codes, np.sqrt((error * error).sum(axis=1)) * (1 + 1e-12)


def decode(codes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    return levels[np.arange(levels.shape[0])[None, :], codes]


def bounded(q: np.ndarray, p: np.ndarray, error: np.ndarray, k: int, skip: np.ndarray | None = None):
    """(row, column, low, high) of all pairs whose lower bound is within the k-th smallest upper bound of the row."""
    parts = []
    p2 = (p * p).sum(axis=1)
    step = max(1, CHUNK // max(len(p), 1))
    for s in range(0, len(q), step):
        qs = q[s:s + step]
        q2 = (qs * qs).sum(axis=1)
        d2 = q2[:, None] + p2[None, :] - 2.0 * (qs @ p.T)
        margin = 1e-9 * (1.0 + q2[:, None] + p2[None, :])  # what the matrix product may be off
        high = np.sqrt(np.maximum(d2, 0) + margin) + error[None, :]
        low = np.maximum(np.sqrt(np.maximum(d2 - margin, 0)) - error[None, :], 0)
        if skip is not None:
            own = skip[s:s + step]
            hit = np.nonzero(own >= 0)[0]
            high[hit, own[hit]] = low[hit, own[hit]] = np.inf
        mask = np.isfinite(low)
        if k < high.shape[1]:
            mask &= low <= np.partition(high, k - 1, axis=1)[:, k - 1][:, None]
        rows, cols = np.nonzero(mask)
        parts.append((rows + s, cols, low[rows, cols], high[rows, cols]))
    if not parts:
        return (np.zeros(0, int),) * 2 + (np.zeros(0),) * 2
    return tuple(np.concatenate(x) for x in zip(*parts))


def survivors(queries: DataFrame, points: DataFrame, k: int, exclude_self: bool, n_points: int) -> DataFrame:
    """(query_id, point_id) of all pairs that bounds from codes leave possible; the k nearest are among them, ties included."""
    spark = queries.sparkSession
    q_block = limit_of(spark, BLOCK_ROWS)
    p_block = 8 * q_block  # a code takes an eighth of its vector
    want = k + (1 if exclude_self else 0)
    dimensions = max(1, points.select(F.size("vec").alias("d")).first()["d"])
    n_pivots = min(max(2, -(-n_points // p_block)), max(2, PIVOT_VALUES // dimensions))
    sample = matrix_of(points.orderBy(F.md5(F.col("point_id").cast("string"))).limit(max(n_pivots, SAMPLE))
                       .select("vec").toArrow().column("vec"))
    pivots, levels = sample[:n_pivots], levels_of(sample[:SAMPLE])
    shared, grid = spark.sparkContext.broadcast(pivots), spark.sparkContext.broadcast(levels)
    pid = points.schema["point_id"].dataType.simpleString()
    qid = queries.schema["query_id"].dataType.simpleString()

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                vectors = matrix_of(batch.column(1))
                _, cols, dist, _ = top_k(vectors, shared.value, 1)
                codes, error = encode(vectors, grid.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                     pa.array(cols.astype("int32")), pa.array(dist), batch.column(2)],
                    names=["point_id", "code", "error", "cell", "r", "same"])

    marked = points.withColumn("same", F.xxhash64("vec"))
    placed = marked.mapInArrow(place, f"point_id {pid}, code binary, error double, cell int, r double, same long")
    # of equal points only those of the smallest ids can be neighbors; the limit is applied before the shuffle too
    equal = Window.partitionBy("same", "code", "error").orderBy("point_id")
    placed = cut_lineage(placed.withColumn("i", F.row_number().over(equal)).filter(F.col("i") <= want).drop("i", "same"))
    stats = {row["cell"]: (row["n"], row["radius"])
             for row in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("r").alias("radius")).collect()}
    n_cells = len(pivots)
    # the nearest points of each cell, at most so many that their table stays as small as that of the pivots
    per_cell = max(1, min(want, PIVOT_VALUES // n_cells))
    inner = (placed.select("cell", "r")
             .withColumn("i", F.row_number().over(Window.partitionBy("cell").orderBy("r")))
             .filter(F.col("i") <= per_cell).select("cell", "r").toPandas())
    radius = np.array([stats.get(c, (0, -np.inf))[1] for c in range(n_cells)])
    counts = [stats.get(c, (0, 0.0))[0] for c in range(n_cells)]
    bounds = spark.sparkContext.broadcast((radius, inner["cell"].to_numpy(), inner["r"].to_numpy()))

    def visited(q):
        rad, cells, rs = bounds.value
        piv = shared.value
        out = []
        step = max(1, CHUNK // max(len(cells), 1))
        for s in range(0, len(q), step):
            qs = q[s:s + step]
            d = np.sqrt(np.maximum(((qs * qs).sum(1)[:, None] + (piv * piv).sum(1)[None, :] - 2 * qs @ piv.T), 0))
            upper = np.full(len(qs), np.inf)
            if want <= len(cells):
                upper = np.partition(d[:, cells] + rs[None, :], want - 1, axis=1)[:, want - 1]
            lower = np.maximum(d - rad[None, :], (d - d.min(axis=1)[:, None]) / 2)
            slack = 1e-6 * (1.0 + np.where(np.isfinite(upper), upper, 0.0) + d.max(axis=1))
            r, c = np.nonzero((lower <= (upper + slack)[:, None]) & np.isfinite(rad)[None, :])
            out.append((r + s, c))
        return tuple(np.concatenate(x) for x in zip(*out))

    def count_visits(batches):
        n = np.zeros(n_cells, dtype="int64")
        for batch in batches:
            if batch.num_rows:
                n += np.bincount(visited(matrix_of(batch.column(1)))[1], minlength=n_cells)
        hit = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype("int32")), pa.array(n[hit])], names=["cell", "n"])

    def send(batches):
        for batch in batches:
            if batch.num_rows:
                rows, cells = visited(matrix_of(batch.column(1)))
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(cells.astype("int32"))],
                    names=["query_id", "vec", "cell"])

    visits = {row["cell"]: row["n"] for row in
              queries.mapInArrow(count_visits, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    # blocks per cell on both sides: a hot cell is split until a block holds a bounded number of rows
    p_blocks = F.lit([max(1, -(-c // p_block)) for c in counts])
    q_blocks = F.lit([max(1, -(-visits.get(c, 0) // q_block)) for c in range(n_cells)])
    at = F.col("cell") + 1
    pts = (
        placed.filter(F.col("cell").isin([int(c) for c in visits])).drop("r")
        .withColumn("pb", F.pmod(F.xxhash64("point_id"), F.element_at(p_blocks, at).cast("long")))
        .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.element_at(q_blocks, at).cast("long") - 1)))
    )
    qs = (
        queries.mapInArrow(send, f"query_id {qid}, vec array<double>, cell int")
        .withColumn("qb", F.pmod(F.xxhash64("query_id"), F.element_at(q_blocks, at).cast("long")))
        .withColumn("pb", F.explode(F.sequence(F.lit(0).cast("long"), F.element_at(p_blocks, at).cast("long") - 1)))
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "point_id": [], "low": [], "high": []})
        ids = right["point_id"].to_numpy()
        codes = np.frombuffer(b"".join(right["code"]), np.uint8).reshape(len(ids), -1)
        own = pd.Index(ids).get_indexer(left["query_id"]) if exclude_self else None
        rows, cols, low, high = bounded(np.stack(left["vec"]), decode(codes, grid.value), right["error"].to_numpy(), k, own)
        return pd.DataFrame({"query_id": left["query_id"].to_numpy()[rows], "point_id": ids[cols], "low": low, "high": high})

    groups = ["cell", "pb", "qb"]
    found = qs.groupBy(*groups).cogroup(pts.groupBy(*groups)).applyInPandas(
        search, f"query_id {qid}, point_id {pid}, low double, high double")
    by_high = Window.partitionBy("query_id").orderBy("high").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return found.withColumn("limit", F.nth_value("high", k).over(by_high)).filter("low <= limit").select("query_id", "point_id")


def _measured(pairs: DataFrame, queries: DataFrame, points: DataFrame, schema: str) -> DataFrame:
    """Exact distances of the surviving pairs, from full vectors."""
    joined = pairs.join(points.withColumnRenamed("vec", "p"), "point_id").join(queries.withColumnRenamed("vec", "q"), "query_id")

    def measure(batches):
        for batch in batches:
            if batch.num_rows:
                q, p = matrix_of(batch.column(2)), matrix_of(batch.column(3))
                every = np.arange(batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(_exact(q, p, every, every)), pa.array(np.ones(len(every), "int32"))],
                    names=["query_id", "point_id", "distance", "rank"])

    return joined.select("query_id", "point_id", "q", "p").mapInArrow(measure, schema)
