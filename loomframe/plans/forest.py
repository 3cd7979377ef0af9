"""Forests grown level by level, all trees at once.

Rows are stored once as bin codes with a Poisson weight per tree. A level is one aggregation: tasks route their rows through
the trees so far and add up weights per (tree, node, feature, bin, class); the sums are shuffled by (tree, node, feature),
which keeps a feature's bins of one node together (at most bins x classes rows), and the best split per feature, then per node, is
found there. The driver gets one row per open node. Classes are rows, not columns, so their number is not limited by a plan's width.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomframe.functions.keys import hash_key, poisson_bounds
from loomframe.plans.levelwise import feature_count
from loomframe.plans.runtime import stored

CELLS = 4_000_000  # sums that a task holds in one array; beyond, only those that occur in a batch
ROUTED = 32_768  # rows routed at once
NO_VALUE = np.iinfo(np.uint16).max  # the code of NULL: it goes right at every split
MOST_BINS = 1_024
POISSON = np.array(poisson_bounds())


@dataclass
class Grown:
    """A tree as arrays by node; nodes are numbered as they come, the root is 0."""

    feature: list[int] = field(default_factory=lambda: [-1])
    code: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    heap: list[int] = field(default_factory=lambda: [1])  # 1 is the root, 2 n and 2 n + 1 are the children of n
    weights: list[np.ndarray | None] = field(default_factory=lambda: [None])  # class weights

    def split(self, node: int, feature: int, code: int, left: np.ndarray, right: np.ndarray) -> None:
        self.feature[node], self.code[node] = feature, code
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for side, w in enumerate((left, right)):
            for name, value in (("feature", -1), ("code", 0), ("left", 0), ("right", 0), ("depth", self.depth[node] + 1),
                                ("heap", 2 * self.heap[node] + side), ("weights", w)):
                getattr(self, name).append(value)

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x) for x in (self.feature, self.code, self.left, self.right))


def leaves(arrays: tuple[np.ndarray, ...], values: np.ndarray) -> np.ndarray:
    """The node at which each row of values ends; a value of at most the node's goes left."""
    feature, limit, left, right = arrays
    at, every = np.zeros(len(values), dtype=np.int64), np.arange(len(values))
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        with np.errstate(invalid="ignore"):
            low = values[every, np.maximum(f, 0)] <= limit[at]
        at = np.where(inner, np.where(low, left[at], right[at]), at)


def bin_edges(df: DataFrame, features, bins: int) -> list[np.ndarray]:
    """Upper edges of each feature's bins: all its values if there are at most `bins`, else values at equal shares."""
    shares = [i / bins for i in range(1, bins + 1)]
    x = {c: F.col(c).cast("double") for c in features}
    row = df.agg(*[F.percentile_approx(x[c], shares, 100 * bins).alias(f"q{i}") for i, c in enumerate(features)],
                 *[F.approx_count_distinct(x[c], 0.02).alias(f"n{i}") for i, c in enumerate(features)]).first()
    few = [i for i in range(len(features)) if row[f"n{i}"] <= 1.2 * bins]
    values: dict[int, list[float]] = {}
    if few:
        pairs = F.array(*[F.struct(F.lit(i).alias("f"), x[features[i]].alias("v")) for i in few])
        found = df.select(F.inline(pairs)).filter("v IS NOT NULL").distinct()  # about 1.2 x bins values a feature
        values = {r["f"]: r["v"] for r in found.groupBy("f").agg(F.sort_array(F.collect_list("v")).alias("v")).collect()}
    out = []
    for i in range(len(features)):
        own = values.get(i, [])
        out.append(np.array(own if 0 < len(own) <= bins else sorted(set(row[f"q{i}"] or [])), dtype=float))
    return out


def prepared(df: DataFrame, features, label: Column, id_col, n_trees: int, seed: int, edges: list[np.ndarray]) -> DataFrame:
    """(x, y, w): bin codes as bytes, the class number and a Poisson weight a tree; rows without a class are left out."""
    # the first eight digits of each tree's hash; the draw that keys.poisson_one(keys.uniform(hash)) makes is made from them in the task
    draws = F.concat(*[F.substring(hash_key(seed, F.lit(t), id_col), 1, 8) for t in range(n_trees)])
    rows = df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), label.cast("int").alias("y"),
                     draws.alias("w")).filter("y >= 0")

    def code(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            codes = np.empty(x.shape, np.uint16)
            for i, e in enumerate(edges):
                known = ~np.isnan(x[:, i])
                codes[:, i] = np.where(known, np.minimum(np.searchsorted(e, x[:, i], "left"), max(len(e) - 1, 0)), NO_VALUE)
            u = np.frombuffer(bytes.fromhex("".join(batch.column(2).to_pylist())), ">u4").reshape(batch.num_rows, -1) / 2.0 ** 32
            w = np.searchsorted(POISSON, u, "right").astype(np.uint8)
            yield pa.RecordBatch.from_arrays([_binary(codes), batch.column(1), _binary(w)], names=["x", "y", "w"])

    return stored(rows.mapInArrow(code, "x binary, y int, w binary"))


def _binary(rows: np.ndarray) -> pa.Array:
    """The bytes of each row of a matrix, as one column."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    """The matrix whose rows' bytes a column holds."""
    if not len(column):
        return np.empty((0, width), kind)
    ends = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    first, last = ends[column.offset], ends[column.offset + len(column)]
    return np.frombuffer(column.buffers()[2], np.uint8)[first:last].view(kind).reshape(-1, width)


def _rows_of(batch, n_features: int, n_trees: int):
    return _matrix(batch.column(0), np.uint16, n_features), batch.column(1).to_numpy(), _matrix(batch.column(2), np.uint8, n_trees)


def _gathered(batches, n_features: int, n_trees: int):
    """Rows of several batches, ROUTED at once: what is paid for each lot does not depend on the size of a batch."""
    held, size = [], 0
    for batch in chain(batches, [None]):  # None: the last lot may be smaller
        if batch is not None and batch.num_rows:
            held.append(_rows_of(batch, n_features, n_trees))
            size += batch.num_rows
        if held and (batch is None or size >= ROUTED):
            lot = [np.concatenate(c) for c in zip(*held)]
            for i in range(0, size, ROUTED):
                yield [c[i:i + ROUTED] for c in lot]
            held, size = [], 0


def class_weights(rows: DataFrame, n_trees: int, n_classes: int) -> list[np.ndarray]:
    """The weight of each class in each tree."""
    def add(batches):
        total = np.zeros((n_trees, n_classes))
        for batch in batches:
            y = batch.column(0).to_numpy()
            w = _matrix(batch.column(1), np.uint8, n_trees)
            for t in range(n_trees):
                total[t] += np.bincount(y, weights=w[:, t], minlength=n_classes)
        t, c = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(c, pa.int32()), pa.array(total[t, c])], names=["t", "y", "n"])

    out = [np.zeros(n_classes) for _ in range(n_trees)]
    for r in rows.select("y", "w").mapInArrow(add, "t int, y int, n double").groupBy("t", "y").agg(F.sum("n").alias("n")).collect():
        out[r["t"]][r["y"]] = r["n"]
    return out


def allowed_features(seed: int, tree: int, heap: int, n_features: int, k: int) -> list[int]:
    """The k features of least md5(seed | tree | node | feature)."""
    order = sorted(range(n_features), key=lambda f: hashlib.md5(f"{seed}|{tree}|{heap}|{f}".encode()).hexdigest())
    return sorted(order[:k])


def histogram(rows: DataFrame, trees: list[Grown], todo: list[tuple[int, int]], allowed: list[list[int]], n_features: int,
              n_classes: int, bins: int = MOST_BINS) -> DataFrame:
    """(place, f, code, y, n): weights by open node (its place in todo), feature, bin (of so many at most; NULL is MOST_BINS) and class."""
    arrays, n_trees = [t.arrays() for t in trees], len(trees)
    place = [np.full(len(t.feature), -1, np.int64) for t in trees]
    for i, (t, node) in enumerate(todo):
        place[t][node] = i
    wanted = np.zeros((len(todo), n_features), bool)
    for i, fs in enumerate(allowed):
        wanted[i, fs] = True
    span = bins + 1
    size = len(todo) * n_features * span * n_classes
    active = sorted({t for t, _ in todo})

    def unpacked(keys, sums):
        keys, y = np.divmod(keys, n_classes)
        keys, code = np.divmod(keys, span)
        at, f = np.divmod(keys, n_features)
        code = np.where(code == bins, MOST_BINS, code)
        for i in range(0, len(sums), 100_000):
            s = slice(i, i + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[s], pa.int32()), pa.array(f[s], pa.int32()), pa.array(code[s], pa.int32()), pa.array(y[s], pa.int32()),
                 pa.array(sums[s], pa.float64())], names=["place", "f", "code", "y", "n"])

    def add(batches):
        held = np.zeros(size) if size <= CELLS else None
        for x, y, w in _gathered(batches, n_features, n_trees):
            codes = [(np.minimum(x[:, f], bins).astype(np.int64) + span * f) * n_classes + y for f in range(n_features)]
            keys, weights = [], []
            for t in active:
                r = np.flatnonzero(w[:, t])
                at = place[t][leaves(arrays[t], x[r])]
                r, at = r[at >= 0], at[at >= 0]
                for f in range(n_features):
                    use = wanted[at, f]
                    some = r[use]
                    keys.append(codes[f][some] + at[use] * (n_features * span * n_classes))
                    weights.append(w[some, t])
            if not sum(map(len, keys)):
                continue
            keys, weights = np.concatenate(keys), np.concatenate(weights).astype(float)
            if held is not None:
                held += np.bincount(keys, weights=weights, minlength=size)
            else:
                some, where = np.unique(keys, return_inverse=True)
                yield from unpacked(some, np.bincount(where, weights=weights))
        if held is not None:
            some = np.flatnonzero(held)
            yield from unpacked(some, held[some])

    found = rows.mapInArrow(add, "place int, f int, code int, y int, n double")
    return found.groupBy("place", "f", "code", "y").agg(F.sum("n").alias("n"))


def impurity(counts: np.ndarray, kind: str) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        p = counts / counts.sum(axis=-1, keepdims=True)
        if kind == "gini":
            return 1.0 - (p * p).sum(axis=-1)
        return -np.where(p > 0, p * np.log2(p), 0.0).sum(axis=-1)


def best_splits(sums: DataFrame, totals: dict[int, np.ndarray], n_classes: int, criterion: str, min_leaf: float) -> DataFrame:
    """(place, gain, f, code, left): the split of largest gain of each open node; the lowest feature, then value on ties.

    A node's bins of one feature are consecutive rows of a task, looked at when they are complete.
    """
    def search(batches):
        held, key = [], None

        def flush():
            rows = np.concatenate(held)
            codes, at = np.unique(rows[:, 2].astype(np.int64), return_inverse=True)
            counts = np.zeros((len(codes), n_classes))
            np.add.at(counts, (at, rows[:, 3].astype(np.int64)), rows[:, 4])
            left = counts.cumsum(axis=0)
            total = totals[key[0]]
            right, n = total - left, total.sum()
            nl, nr = left.sum(axis=1), right.sum(axis=1)
            with np.errstate(invalid="ignore"):
                gain = impurity(total, criterion) - nl / n * impurity(left, criterion) - nr / n * impurity(right, criterion)
            ok = np.flatnonzero((nl >= max(min_leaf, 1)) & (nr >= max(min_leaf, 1)) & (codes < MOST_BINS))
            if len(ok):
                i = ok[np.argmax(np.round(gain[ok], 12))]
                return key[0], float(np.round(gain[i], 12)), key[1], int(codes[i]), left[i].tolist()

        out = []
        for batch in batches:
            rows = np.column_stack([c.to_numpy() for c in batch.columns])
            cuts = np.flatnonzero((np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)) + 1
            starts = [0, *cuts.tolist(), len(rows)]
            for s, e in zip(starts, starts[1:]):
                if s == e:
                    continue
                now = (int(rows[s, 0]), int(rows[s, 1]))
                if now != key:
                    if held:
                        out.append(flush())
                    held, key = [], now
                held.append(rows[s:e])
        if held:
            out.append(flush())
        out = [r for r in out if r is not None]
        kinds = (pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 5, kinds)], names=["place", "gain", "f", "code", "left"])

    # place and feature as one key: a node's features are spread over tasks
    dealt = sums.repartition("place", "f").sortWithinPartitions("place", "f")
    per_feature = dealt.select("place", "f", "code", "y", "n").mapInArrow(search, "place int, gain double, f int, code int, left array<double>")
    best = F.max(F.struct("gain", (-F.col("f")).alias("f"), (-F.col("code")).alias("code"), "left")).alias("b")
    return per_feature.groupBy("place").agg(best).select("place", "b.gain", (-F.col("b.f")).alias("f"), (-F.col("b.code")).alias("code"), "b.left")


def grow_forest(df: DataFrame, features, label: Column, n_classes: int, id_col, n_trees: int, max_depth: int, max_features,
                min_split: float, min_leaf: float, criterion: str, bins: int, seed: int) -> tuple[list[Grown], list[np.ndarray]]:
    """Trees and the upper edges of the features' bins."""
    if not 2 <= bins <= MOST_BINS:
        raise ValueError(f"bins must be between 2 and {MOST_BINS}")
    features = list(features)
    edges = bin_edges(df, features, bins)
    rows = prepared(df, features, label, id_col, n_trees, seed, edges)
    k = feature_count(max_features, len(features))
    trees = [Grown(weights=[w]) for w in class_weights(rows, n_trees, n_classes)]
    if not any(t.weights[0].sum() for t in trees):
        raise ValueError("cannot grow a forest on an empty table")
    open_nodes = [(t, 0) for t in range(n_trees)]
    while open_nodes:
        todo = [(t, node) for t, node in open_nodes if trees[t].depth[node] < max_depth
                and trees[t].weights[node].sum() >= min_split and (trees[t].weights[node] > 0).sum() > 1]
        if not todo:
            break
        allowed = [allowed_features(seed, t, trees[t].heap[node], len(features), k) for t, node in todo]
        totals = {i: trees[t].weights[node] for i, (t, node) in enumerate(todo)}
        sums = histogram(rows, trees, todo, allowed, len(features), n_classes, max(map(len, edges)))
        open_nodes = []
        for r in sorted(best_splits(sums, totals, n_classes, criterion, min_leaf).collect(), key=lambda r: r["place"]):
            t, node = todo[r["place"]]
            left = np.array(r["left"])
            trees[t].split(node, r["f"], r["code"], left, trees[t].weights[node] - left)
            open_nodes += [(t, trees[t].left[node]), (t, trees[t].right[node])]
    return trees, edges
