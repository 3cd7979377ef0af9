"""Graph features over edge tables (graph, src, dst[, w]) and node tables (graph, node)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.functions.arrays import EPSILON
from loomframe.functions.scalar import ACTIVATIONS
from loomframe.plans.ordering import Ordered
from loomframe.plans.runtime import BLOCK_ROWS, BROADCAST_ROWS, cut_lineage, limit_of, settle

SEARCH_PLACES = 2_000_000  # (group of sources, node) of a search in a task: three arrays of 16 MB


def undirected(edges: DataFrame, graph: str = "graph_id") -> DataFrame:
    """Distinct edges with src < dst, self-loops left out."""
    return (edges.filter("src <> dst")
            .select(graph, F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct())


def degrees(edges: DataFrame, nodes: DataFrame, graph: str = "graph_id") -> DataFrame:
    """(graph, node, degree), isolated nodes with 0."""
    e = undirected(edges, graph)
    ends = e.select(graph, F.explode(F.array("src", "dst")).alias("node"))
    counts = ends.groupBy(graph, "node").agg(F.count("*").alias("degree"))
    return nodes.select(graph, "node").join(counts, [graph, "node"], "left").fillna(0, ["degree"])


def degree_stats(edges: DataFrame, nodes: DataFrame, graph: str = "graph_id") -> DataFrame:
    return degrees(edges, nodes, graph).groupBy(graph).agg(
        F.avg("degree").alias("avg_degree"), F.max("degree").alias("max_degree"))


def avg_clustering(edges: DataFrame, nodes: DataFrame, graph: str = "graph_id") -> DataFrame:
    """Mean local clustering.

    Edges point from the lower to the higher degree, so no node opens more than about sqrt(2 * edges)
    neighbor pairs, and a hub opens none of its own.
    """
    e = undirected(edges, graph)
    degree = degrees(e, nodes, graph)
    d = degree.select(graph, "node", "degree")
    with_d = (e.join(d.select(graph, F.col("node").alias("src"), F.col("degree").alias("ds")), [graph, "src"])
              .join(d.select(graph, F.col("node").alias("dst"), F.col("degree").alias("dd")), [graph, "dst"]))
    forward = F.struct("ds", "src") < F.struct("dd", "dst")
    out = cut_lineage(_oriented(with_d, graph, forward))
    left = out.select(graph, "a", F.col("b").alias("x"), F.col("db").alias("dx"))
    right = out.select(graph, "a", F.col("b").alias("y"), F.col("db").alias("dy"))
    wedges = left.join(right, [graph, "a"]).filter(F.struct("dx", "x") < F.struct("dy", "y"))
    closing = out.select(graph, F.col("a").alias("x"), F.col("b").alias("y"))
    triangles = wedges.join(closing, [graph, "x", "y"]).select(graph, F.explode(F.array("a", "x", "y")).alias("node"))
    per_node = triangles.groupBy(graph, "node").agg(F.count("*").alias("t"))
    k = F.col("degree")
    local = F.when(k >= 2, 2.0 * F.coalesce("t", F.lit(0)) / F.greatest(k * (k - 1), F.lit(1))).otherwise(0.0)
    return (degree.join(per_node, [graph, "node"], "left").groupBy(graph)
            .agg(F.avg(local).alias("avg_clustering")))


def _oriented(with_d: DataFrame, graph: str, forward) -> DataFrame:
    return with_d.select(
        graph, F.when(forward, F.col("src")).otherwise(F.col("dst")).alias("a"),
        F.when(forward, F.col("dst")).otherwise(F.col("src")).alias("b"),
        F.when(forward, F.col("dd")).otherwise(F.col("ds")).alias("db"))


def avg_betweenness(edges: DataFrame, nodes: DataFrame, graph: str = "graph_id") -> DataFrame:
    """Mean normalized betweenness.

    The sum of betweenness over all nodes equals the sum of (distance - 1) over reachable pairs, so one search per
    source node with its plain distances is enough. 64 sources are searched at once, a bit of a long each. Graphs whose
    edges fit a task are searched there, their sources spread over many tasks; a larger graph is searched by joins, all
    sources together up to 64 times blockRows of them. Pairs are summed where they are found.
    """
    spark = edges.sparkSession
    limit, block = limit_of(spark, BROADCAST_ROWS), limit_of(spark, BLOCK_ROWS)
    e = cut_lineage(undirected(edges, graph))
    sizes = nodes.groupBy(graph).agg(F.count("*").alias("n"))
    weights = e.groupBy(graph).agg(F.count("*").alias("m"))
    sources = degrees(e, nodes, graph).filter("degree > 0").select(graph, "node")
    small = weights.filter(F.col("m") <= limit).select(graph, "m")
    sums = _search_in_tasks(e, sources, small, graph)
    big = [row[graph] for row in weights.filter(F.col("m") > limit).select(graph).collect()]
    for g in big:
        sums = sums.unionByName(_search_by_joins(e, sources, graph, g, block))
    total = sums.groupBy(graph).agg(F.sum("s").alias("s"))
    n = F.col("n").cast("double")
    mean = F.when(n > 2, F.coalesce("s", F.lit(0)) / F.greatest((n - 1) * (n - 2) * n, F.lit(1.0))).otherwise(0.0)
    return sizes.join(total, graph, "left").select(graph, mean.alias("avg_betweenness"))


def _search_in_tasks(e: DataFrame, sources: DataFrame, small: DataFrame, graph: str) -> DataFrame:
    """(graph, s): sum of (distance - 1) over ordered reachable pairs, searched per (graph, source chunk).

    A chunk gets its graph's edges and all sources, and takes a range of the order in which a search meets them: sources near
    each other pass the same nodes at the same time, so their bits travel together.
    """
    # a chunk carries one copy of its graph's edges
    per_graph = small.join(sources.groupBy(graph).agg(F.count("*").alias("k")), graph)
    chunks = per_graph.select(graph, F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("k").cast("double")) / 16)).cast("long").alias("chunks"))
    chunks = settle(chunks).hinted()
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    times = sources.groupBy(graph, "node").agg(F.count("*").alias("times"))
    src = times.join(chunks, graph).select(graph, chunk.alias("chunk"), "chunks", "node", "times")
    copies = e.join(chunks, graph).select(graph, chunk.alias("chunk"), "src", "dst")
    kind = e.schema[graph].dataType.simpleString()

    def search(key, nodes: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        ids = pd.Index(pd.unique(np.concatenate([part["src"].to_numpy(), part["dst"].to_numpy()])))
        a, b = ids.get_indexer(part["src"]), ids.get_indexer(part["dst"])
        heads, tails = np.concatenate([a, b]), np.concatenate([b, a])
        order = np.argsort(heads, kind="stable")
        tails, starts = tails[order], np.searchsorted(heads[order], np.arange(len(ids) + 1))
        times = np.zeros(len(ids), np.int64)
        np.add.at(times, ids.get_indexer(nodes["node"]), nodes["times"].to_numpy())
        met = _met_order(starts, tails)
        mine = np.array_split(np.repeat(met, times[met]), int(nodes["chunks"].iloc[0]))[int(key[1])]
        return pd.DataFrame({graph: [key[0]], "s": [_distances(starts, tails, mine)]})

    return (src.groupBy(graph, "chunk").cogroup(copies.groupBy(graph, "chunk"))
            .applyInPandas(search, f"{graph} {kind}, s long"))


def _met_order(starts: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """All nodes in the order in which searches meet them, one search per component."""
    n = len(starts) - 1
    seen, out, at = np.zeros(n, bool), np.empty(n, np.int64), 0
    for root in range(n):
        if seen[root]:
            continue
        seen[root] = True
        out[at], done, at = root, at, at + 1
        while done < at:
            v, done = out[done], done + 1
            for w in tails[starts[v]:starts[v + 1]].tolist():
                if not seen[w]:
                    seen[w] = True
                    out[at], at = w, at + 1
    return out


def _distances(starts: np.ndarray, tails: np.ndarray, sources: np.ndarray) -> int:
    """The sum of (distance - 1) from the sources to all other nodes they reach.

    64 sources share a long, and many such groups are searched at once: a place is a group and a node. A level touches only
    the places it reaches.
    """
    n, total = len(starts) - 1, 0
    degree = np.diff(starts)
    many = 64 * max(1, SEARCH_PLACES // n)
    for first in range(0, len(sources), many):
        some = sources[first:first + many]
        i = np.arange(len(some))
        size = n * (-(-len(some) // 64))
        seen, reached, last = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.empty(size, np.int64)
        place = i // 64 * n + some
        np.bitwise_or.at(seen, place, np.uint64(1) << (i % 64).astype(np.uint64))
        place = np.unique(place)
        node, bits, level = place % n, seen[place], 0
        while place.size:
            # the edges of these nodes only: their places in `tails`, laid end to end
            sizes = degree[node]
            ends = np.cumsum(sizes)
            to = tails[np.repeat(starts[node] - (ends - sizes), sizes) + np.arange(ends[-1])]
            target = to + np.repeat(place - node, sizes)
            np.bitwise_or.at(reached, target, np.repeat(bits, sizes))
            numbers = np.arange(len(target))
            last[target] = numbers  # of the edges to one place, one is kept
            kept = np.flatnonzero(last[target] == numbers)
            target, to = target[kept], to[kept]
            bits = reached[target] & ~seen[target]
            reached[target] = 0
            new = np.flatnonzero(bits)
            place, node, bits = target[new], to[new], bits[new]
            seen[place] |= bits
            total += int(np.bitwise_count(bits).sum(dtype=np.int64)) * level
            level += 1
    return total


def _search_by_joins(e: DataFrame, sources: DataFrame, graph: str, g, block: int) -> DataFrame:
    """The same sum for one large graph: a level is a join with the edges and one `bit_or` per node and group of 64 sources.

    Edges lead from a level to itself, the one before and the one after, so what was seen earlier is not needed.
    """
    spark = e.sparkSession
    one = e.filter(F.col(graph) == F.lit(g))
    both = one.select("src", "dst").unionByName(one.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = cut_lineage(both)
    mine = cut_lineage(sources.filter(F.col(graph) == F.lit(g)).select("node"))
    numbered = cut_lineage(Ordered(mine, [], [F.col("node")], F.col("node")).positions("_i").rows().select("node", "_i"))
    batch, total = 64 * block, 0
    for first in range(0, numbered.count(), batch):
        some = numbered.filter((F.col("_i") >= first) & (F.col("_i") < first + batch))
        frontier = cut_lineage(some.select(F.col("node").alias("v"), F.expr("_i DIV 64").alias("many"),
                                           F.expr("shiftleft(1L, CAST(_i % 64 AS INT))").alias("bits")))
        before, level = frontier.limit(0), 0
        while True:
            reached = frontier.join(both, frontier["v"] == both["src"]).select(
                F.col("dst").alias("v"), "many", "bits", F.lit(0).cast("long").alias("old"))
            known = frontier.unionByName(before).select("v", "many", F.lit(0).cast("long").alias("bits"), F.col("bits").alias("old"))
            met = reached.unionByName(known).groupBy("v", "many").agg(F.bit_or("bits").alias("bits"), F.bit_or("old").alias("old"))
            found = cut_lineage(met.select("v", "many", F.col("bits").bitwiseAND(F.bitwise_not("old")).alias("bits")).filter("bits <> 0"))
            pairs = found.agg(F.sum(F.bit_count("bits")).alias("n")).first()["n"]
            if not pairs:
                break
            total += pairs * level
            before, frontier, level = frontier, found, level + 1
    kind = e.schema[graph].dataType.simpleString()
    return spark.createDataFrame([(g, total)], f"{graph} {kind}, s long")


def normalize_adjacency(edges: DataFrame, nodes: DataFrame, mode: str = "symmetric", graph: str = "graph_id") -> DataFrame:
    """Directed weighted edges (graph, src, dst, w) with self-loops added, divided by degrees.

    symmetric: w / sqrt(d_src d_dst); random_walk or left: w / d_src; right: w / d_dst. Degrees are row sums,
    floored at 1e-7.
    """
    if mode not in ("symmetric", "random_walk", "left", "right"):
        raise ValueError("mode must be symmetric, random_walk, left or right")
    loops = nodes.select(graph, F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(1.0).alias("w"))
    full = (edges.select(graph, "src", "dst", F.col("w").cast("double").alias("w")).unionByName(loops)
            .groupBy(graph, "src", "dst").agg(F.sum("w").alias("w")))
    d = full.groupBy(graph, "src").agg(F.greatest(F.sum("w"), F.lit(EPSILON)).alias("d"))
    by_src = d.select(graph, "src", F.col("d").alias("d_src"))
    by_dst = d.select(graph, F.col("src").alias("dst"), F.col("d").alias("d_dst"))
    if mode == "symmetric":
        out = full.join(by_src, [graph, "src"]).join(by_dst, [graph, "dst"])
        w = F.col("w") / F.sqrt(F.col("d_src") * F.col("d_dst"))
    elif mode == "right":
        out, w = full.join(by_dst, [graph, "dst"]), F.col("w") / F.col("d_dst")
    else:
        out, w = full.join(by_src, [graph, "src"]), F.col("w") / F.col("d_src")
    return out.select(graph, "src", "dst", w.alias("w"))


def graph_convolve(adjacency: DataFrame, features: DataFrame, cols, weights, bias=None, activation: str = "relu",
                   graph: str = "graph_id") -> DataFrame:
    """activation(A X W + b): one join and one sum per node; W and b are given as numbers.

    Features are multiplied by W before they travel when that makes rows narrower.
    """
    w = np.asarray(weights, dtype=float)
    n_in, n_out = w.shape
    if n_in != len(cols):
        raise ValueError("weights need one row per feature column")
    b = np.zeros(n_out) if bias is None else np.asarray(bias, dtype=float)

    def times_w(columns):
        out = []
        for j in range(n_out):
            s = F.lit(0.0)
            for i, c in enumerate(columns):
                s = s + c * F.lit(float(w[i, j]))
            out.append(s)
        return out

    early = n_out <= n_in
    x = [F.col(c).cast("double") for c in cols]
    moved = times_w(x) if early else x
    f = features.select(graph, F.col("node").alias("dst"), *[m.alias(f"_x{i}") for i, m in enumerate(moved)])
    sums = (adjacency.join(f, [graph, "dst"]).groupBy(graph, "src")
            .agg(*[F.sum(F.col("w") * F.col(f"_x{i}")).alias(f"_x{i}") for i in range(len(moved))]))
    h = [F.col(f"_x{i}") for i in range(len(moved))]
    h = h if early else times_w(h)
    act = ACTIVATIONS[activation]
    return sums.select(graph, F.col("src").alias("node"), *[act(v + F.lit(float(b[j]))).alias(f"h{j}") for j, v in enumerate(h)])
