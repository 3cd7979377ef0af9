"""Nearest-neighbor models and selections on top of the exact neighbor join.

Tables of points are (id, vec[, label]); `vec` is an array of doubles.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomframe.functions.scalar import FLOAT_EPS
from loomframe.plans.nearest import knn_join, local_matrix
from loomframe.plans.runtime import BLOCK_ROWS, cut_lineage, limit_of


def vectors(df: DataFrame, id_col: str, cols, id_name: str) -> DataFrame:
    """(id_name, vec) from one array column or several numeric columns."""
    vec = F.col(cols) if isinstance(cols, str) else F.array(*[F.col(c).cast("double") for c in cols])
    return df.select(F.col(id_col).alias(id_name), vec.cast("array<double>").alias("vec"))


def neighbors(queries: DataFrame, points: DataFrame, id_col: str, cols, k: int, exclude_self: bool = False,
              point_id: str | None = None) -> DataFrame:
    """(query_id, point_id, distance, rank)."""
    return knn_join(vectors(queries, id_col, cols, "query_id"), vectors(points, point_id or id_col, cols, "point_id"),
                    k, exclude_self=exclude_self)


def _weight(weights: str) -> Column:
    if weights == "uniform":
        return F.lit(1.0)
    if weights == "distance":
        return 1.0 / (F.col("distance") + F.lit(FLOAT_EPS))
    raise ValueError("weights must be 'uniform' or 'distance'")


def _labeled(near: DataFrame, points: DataFrame, id_col: str, label: str) -> DataFrame:
    labels = points.select(F.col(id_col).alias("point_id"), F.col(label).alias("label"))
    return near.join(labels, "point_id")


def _votes(near: DataFrame, weights: str) -> DataFrame:
    return near.groupBy("query_id", "label").agg(F.sum(_weight(weights)).alias("votes"))


def knn_classify(queries: DataFrame, points: DataFrame, id_col: str, cols, label: str, k: int = 5,
                 weights: str = "uniform", exclude_self: bool = False) -> DataFrame:
    """(query_id, prediction): most votes, the smallest label on ties."""
    near = _labeled(neighbors(queries, points, id_col, cols, k, exclude_self), points, id_col, label)
    best = F.min(F.struct((-F.col("votes")).alias("v"), F.col("label").alias("label")))
    return _votes(near, weights).groupBy("query_id").agg(best.alias("b")).select(
        "query_id", F.col("b.label").alias("prediction"))


def knn_class_probabilities(queries: DataFrame, points: DataFrame, id_col: str, cols, label: str, k: int = 5,
                            weights: str = "uniform", exclude_self: bool = False) -> DataFrame:
    """(query_id, label, p) with a row for every class."""
    near = _labeled(neighbors(queries, points, id_col, cols, k, exclude_self), points, id_col, label)
    classes = [row[0] for row in points.select(label).distinct().orderBy(label).collect()]
    share = [F.sum(F.when(F.col("label") == F.lit(c), _weight(weights)).otherwise(0.0)) / F.sum(_weight(weights)) for c in classes]
    wide = near.groupBy("query_id").agg(F.array(*share).alias("p"))
    return wide.select("query_id", F.inline(F.arrays_zip(F.lit(classes).alias("label"), F.col("p").alias("p")))).toDF(
        "query_id", "label", "p")


def knn_regress(queries: DataFrame, points: DataFrame, id_col: str, cols, target: str, k: int = 5,
                weights: str = "uniform", exclude_self: bool = False) -> DataFrame:
    near = _labeled(neighbors(queries, points, id_col, cols, k, exclude_self), points, id_col, target)
    w = _weight(weights)
    return near.groupBy("query_id").agg((F.sum(w * F.col("label")) / F.sum(w)).alias("prediction"))


def adaptive_k(points: DataFrame, id_col: str, cols, label: str, min_k: int = 1, max_k: int = 50,
               weights: str = "distance") -> DataFrame:
    """(query_id, best_k): per row the smallest k in [min_k, min(max_k, n - 1)) whose vote, without the row, is right."""
    if min_k < 1:
        raise ValueError("min_k must be positive")
    n = points.count()
    if max_k > n:
        raise ValueError("max_k is larger than the number of points")
    top = min(max_k, n - 1) - 1
    if top < min_k:
        return points.select(F.col(id_col).alias("query_id"), F.lit(min_k).alias("best_k"))
    near = _labeled(neighbors(points, points, id_col, cols, top, exclude_self=True), points, id_col, label)
    own = points.select(F.col(id_col).alias("query_id"), F.col(label).alias("own"))
    upto = Window.partitionBy("query_id", "label").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    run = near.withColumn("votes", F.sum(_weight(weights)).over(upto))
    # the leading label after each rank: every label's votes so far, carried along the ranks of a query
    packed = run.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "label", "votes"))).alias("steps"))

    @F.pandas_udf("int")
    def first_right(steps: pd.Series, own: pd.Series) -> pd.Series:
        out = []
        for rows, label_own in zip(steps, own):
            votes, best = {}, min_k
            for row in rows:
                votes[row["label"]] = row["votes"]
                if row["rank"] >= min_k:
                    winner = min(votes, key=lambda c: (-votes[c], c))
                    if winner == label_own:
                        best = row["rank"]
                        break
            out.append(best)
        return pd.Series(out, dtype="int32")

    return packed.join(own, "query_id").select("query_id", first_right("steps", "own").alias("best_k"))


def adaptive_knn_classify(queries: DataFrame, points: DataFrame, id_col: str, cols, label: str, min_k: int = 1,
                          max_k: int = 50, weights: str = "distance", exclude_self: bool = False) -> DataFrame:
    """knn_classify with k = int(mean best k)."""
    k = int(adaptive_k(points, id_col, cols, label, min_k, max_k, weights).agg(F.avg("best_k")).first()[0])
    return knn_classify(queries, points, id_col, cols, label, k, weights, exclude_self)


def nearest_prototype_classify(queries: DataFrame, prototypes: DataFrame, id_col: str, cols, label: str,
                               prototype_id: str | None = None) -> DataFrame:
    """(query_id, prediction): the label of the nearest prototype, that is, of its Voronoi cell."""
    pid = prototype_id or id_col
    near = neighbors(queries, prototypes, id_col, cols, 1, point_id=pid)
    return _labeled(near, prototypes, pid, label).select("query_id", F.col("label").alias("prediction"))


def edited_selection(points: DataFrame, id_col: str, cols, label: str, k: int = 3) -> DataFrame:
    """The rows of which more than k / 2 of the k nearest others share the label."""
    near = _labeled(neighbors(points, points, id_col, cols, k, exclude_self=True), points, id_col, label)
    own = points.select(F.col(id_col).alias("query_id"), F.col(label).alias("own"))
    agree = near.join(own, "query_id").groupBy("query_id").agg(F.count_if(F.col("label") == F.col("own")).alias("agree"))
    kept = agree.filter(F.col("agree") > k / 2).select(F.col("query_id").alias(id_col))
    return points.join(kept, id_col, "left_semi")


AHEAD, WORKING = 64, 10_000  # rounds guessed at a time, and rows that the guess begins with


def _nearer(vec: np.ndarray, best: np.ndarray, near: np.ndarray, batch: list[tuple], code: dict):
    """The distance, the label's number and the id of the nearest prototype, also considering the batch; ties go to the smaller id."""
    ids, matrix = [b[0] for b in batch], np.array([b[1] for b in batch])
    dist, label, nid = best, near[0], near[1]
    d = np.sqrt(((vec[:, None, :] - matrix[None, :, :]) ** 2).sum(axis=2))
    at = d.argmin(axis=1)
    found = d[np.arange(len(vec)), at]
    better = found < dist
    tied = np.flatnonzero((found == dist) & (label > -2))
    better[tied] = [ids[at[i]] < nid[i] for i in tied]
    return (np.where(better, found, dist), (np.where(better, np.array([code[b[2]] for b in batch])[at], label),
                                            np.where(better, np.array(ids, dtype=object)[at], nid)))


def _fresh_state(n: int):
    """No prototype yet: label -2; a label that is NULL has number -1 and counts neither as missed nor as missing others."""
    return np.full(n, np.inf), (np.full(n, -2), np.full(n, None, dtype=object))


def _first_missed(label: np.ndarray, ids: np.ndarray, near: np.ndarray) -> list[int]:
    """Per label the position of the lowest id whose nearest prototype is of another label."""
    at = np.flatnonzero((label >= 0) & (near >= 0) & (label != near))
    first = {}
    for i in at[np.argsort(ids[at], kind="stable")].tolist():
        first.setdefault(label[i], i)
    return list(first.values())


def condensed_selection(points: DataFrame, id_col: str, cols, label: str) -> DataFrame:
    """Prototypes grown in rounds: the lowest id of each class first, then per round the lowest missed id of each class.

    The rounds to come are guessed from a few rows on the driver. One pass over all rows replays them and tells the lowest missed
    ids of each round; rounds are taken up to the first that was guessed wrong, which is taken as the pass found it, and its
    rows join those the next guess is made from. So the rounds are exact, and a pass settles many. Each row carries its
    nearest prototype so far; of rows equal in vector and label the lowest id alone can be chosen.
    """
    data = points.select(F.col(id_col).alias("id"), F.col(label).alias("label"),
                         (F.col(cols) if isinstance(cols, str) else F.array(*cols)).cast("array<double>").alias("vec"))
    data = cut_lineage(data.groupBy("label", "vec").agg(F.min("id").alias("id")).select("id", "label", "vec"))
    kind, idt = data.schema["label"].dataType.simpleString(), data.schema["id"].dataType.simpleString()
    seeds = data.groupBy("label").agg(F.min_by(F.struct("id", "vec"), "id").alias("s")).select(
        F.col("s.id").alias("id"), F.col("s.vec").alias("vec"), "label")
    as_rows = lambda df: [(r["id"], list(r["vec"]), r["label"]) for r in df.select("id", "vec", "label").collect()]
    rounds, applied = [sorted(as_rows(seeds), key=lambda r: r[0])], 0  # one row per class
    code = {r[2]: -1 if r[2] is None else i for i, r in enumerate(rounds[0])}
    working = {r[0]: r for r in as_rows(data.orderBy("id").limit(WORKING))}
    state = data.select("*", F.lit(float("inf")).alias("best"), F.lit(-2).cast("long").alias("near"), F.lit(None).cast(idt).alias("near_id"))

    def guess() -> list[list[tuple]]:
        rows = list(working.values())
        vec, ids = np.array([r[1] for r in rows]), pd.Series([r[0] for r in rows]).to_numpy()
        own = np.array([code[r[2]] for r in rows])
        best, near = _fresh_state(len(rows))
        for batch in rounds:
            best, near = _nearer(vec, best, near, batch, code)
        out = []
        while len(out) < AHEAD and (first := _first_missed(own, ids, near[0])):
            out.append(sorted((rows[i] for i in first), key=lambda r: r[0]))
            best, near = _nearer(vec, best, near, out[-1], code)
        return out

    def replayed(pdf: pd.DataFrame, plan):
        """The state before the plan and after each of its rounds."""
        vec, best = np.stack(pdf["vec"]), pdf["best"].to_numpy()
        near = pdf["near"].to_numpy(), pdf["near_id"].to_numpy(dtype=object)
        yield best, near
        for batch in plan:
            best, near = _nearer(vec, best, near, batch, code)
            yield best, near

    while rounds[0]:
        plan, settled = rounds[applied:] + guess(), len(rounds) - applied

        def missed(batches, plan=plan, settled=settled):
            for pdf in batches:
                if len(pdf):
                    own = pdf["label"].map(lambda x: -1 if pd.isna(x) else code[x]).to_numpy()
                    for step, (_, near) in enumerate(replayed(pdf, plan)):
                        if step >= settled and (at := _first_missed(own, pdf["id"].to_numpy(), near[0])):
                            yield pdf.iloc[at][["id", "vec", "label"]].assign(step=step)

        told = state.mapInPandas(missed, f"id {idt}, vec array<double>, label {kind}, step int")
        told = told.groupBy("step", "label").agg(F.min_by(F.struct("id", "vec"), "id").alias("s"))
        found: dict[int, list[tuple]] = {}
        for r in told.collect():  # a row per guessed round and class
            row = (r["s"]["id"], list(r["s"]["vec"]), r["label"])
            working[row[0]] = row
            found.setdefault(r["step"], []).append(row)
        step = settled
        while step in found:
            rounds.append(sorted(found[step], key=lambda r: r[0]))
            if step >= len(plan) or plan[step] != rounds[-1]:
                break
            step += 1
        else:
            break  # nothing is missed after this round

        def update(batches, plan=rounds[applied:]):
            for pdf in batches:
                if len(pdf):
                    *_, (best, near) = replayed(pdf, plan)
                    pdf["best"], pdf["near"], pdf["near_id"] = best, near[0], near[1]
                yield pdf

        # materialized once a pass, in the shared folder; lineage stays flat
        state, applied = cut_lineage(state.mapInPandas(update, state.schema)), len(rounds)
    picked = points.sparkSession.createDataFrame([(r[0],) for batch in rounds for r in batch], f"{id_col} {idt}")
    return points.join(F.broadcast(picked), id_col, "left_semi")


KERNELS = {
    "gaussian": lambda d, h: np.exp(-d * d / (2.0 * h * h)),
    "epanechnikov": lambda d, h: np.maximum(0.0, 1.0 - (d / h) ** 2),
}


def locally_weighted_regress(queries: DataFrame, points: DataFrame, id_col: str, cols, target: str,
                             kernel: str = "gaussian", bandwidth: float = 1.0, point_id: str | None = None) -> DataFrame:
    """Per query a weighted least squares fit without intercept; a singular one gives the weighted mean.

    Only sums leave a task: per query the weighted products of the features. Point partitions meet blocks of
    queries of bounded size, whose sums are then added.
    """
    if kernel not in KERNELS:
        raise ValueError(f"kernel must be one of {sorted(KERNELS)}")
    spark = queries.sparkSession
    block = limit_of(spark, BLOCK_ROWS)
    q = vectors(queries, id_col, cols, "query_id")
    vec = F.col(cols) if isinstance(cols, str) else F.array(*[F.col(c).cast("double") for c in cols])
    p = points.select(vec.cast("array<double>").alias("vec"), F.col(target).cast("double").alias("y"),
                      F.col(point_id or id_col).alias("point_id"))
    qid = q.schema["query_id"].dataType.simpleString()
    fn = KERNELS[kernel]

    def sums(qs: np.ndarray, ps: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Rows [sum w x_i x_j ..., sum w x_i y ..., sum w, sum w y] per query."""
        d = ps.shape[1]
        out = np.zeros((len(qs), d * d + d + 2))
        xx = np.einsum("ni,nj->nij", ps, ps).reshape(len(ps), -1)
        right = np.hstack([xx, ps * y[:, None], np.ones((len(ps), 1)), y[:, None]])
        step = max(1, 2_000_000 // max(len(ps) * d, 1))
        for s in range(0, len(qs), step):
            diff = qs[s:s + step, None, :] - ps[None, :, :]
            out[s:s + step] = fn(np.sqrt((diff * diff).sum(axis=2)), bandwidth) @ right
        return out

    local = local_matrix(q, "query_id")
    if local is not None:
        shared = spark.sparkContext.broadcast(local)

        def partial(batches):
            ids, qs = shared.value
            acc = None
            for pdf in batches:
                if len(pdf):
                    part = sums(qs, np.stack(pdf["vec"]), pdf["y"].to_numpy())
                    acc = part if acc is None else acc + part
            if acc is not None:
                yield pd.DataFrame({"query_id": ids, "s": list(acc), "vec": list(qs)})

        parts = p.mapInPandas(partial, f"query_id {qid}, s array<double>, vec array<double>")
    else:
        n_q, n_p = q.count(), p.count()
        qb, pb = -(-n_q // block), -(-n_p // block)
        qs = q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(qb))).withColumn(
            "pb", F.explode(F.sequence(F.lit(0), F.lit(pb - 1))))
        ps = p.withColumn("pb", F.pmod(F.xxhash64("point_id"), F.lit(pb)).cast("int")).withColumn(
            "qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(qb - 1).cast("long"))))

        def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if a.empty or b.empty:
                return pd.DataFrame({"query_id": [], "s": [], "vec": []})
            got = sums(np.stack(a["vec"]), np.stack(b["vec"]), b["y"].to_numpy())
            return pd.DataFrame({"query_id": a["query_id"], "s": list(got), "vec": a["vec"]})

        parts = qs.groupBy("qb", "pb").cogroup(ps.groupBy("qb", "pb")).applyInPandas(
            meet, f"query_id {qid}, s array<double>, vec array<double>")

    first = q.select(F.size("vec").alias("d")).first()["d"]
    n_sums = first * first + first + 2
    added = parts.groupBy("query_id").agg(F.array(*[F.sum(F.col("s")[i]) for i in range(n_sums)]).alias("s"),
                                          F.first("vec").alias("vec"))

    @F.pandas_udf("double")
    def solve(s: pd.Series, vec: pd.Series) -> pd.Series:
        out = []
        for row, x in zip(s, vec):
            d = len(x)
            gram, xy, sw, swy = row[:d * d].reshape(d, d), row[d * d:d * d + d], row[-2], row[-1]
            try:
                out.append(float(np.asarray(x) @ np.linalg.solve(gram, xy)))
            except np.linalg.LinAlgError:
                out.append(float(swy / sw) if sw > 0 else None)
        return pd.Series(out, dtype="float64")

    return added.select("query_id", solve("s", "vec").alias("prediction"))
