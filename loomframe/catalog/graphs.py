"""Graph features. Graph = nation, nodes = customers, edges between keys that differ by 1 or 7, or by 2 for every third."""

from pyspark.sql import functions as F

from loomframe.catalog.registry import query, rounded, table
from loomframe.operators import graph as G

GRAPH = """WITH nodes AS (SELECT c_nationkey AS g, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS node FROM customer),
raw AS (SELECT g, node AS s, node + unnest([1, 7]) AS d FROM nodes UNION ALL SELECT g, node, node + 2 FROM nodes WHERE node % 3 = 0),
e AS (SELECT raw.g, s, d FROM raw JOIN nodes n ON n.g = raw.g AND n.node = raw.d),
alln AS (SELECT * FROM nodes UNION ALL SELECT DISTINCT g, -1 FROM nodes),
both_ends AS (SELECT g, s AS a, d AS b FROM e UNION ALL SELECT g, d, s FROM e),
deg AS (SELECT n.g, n.node, count(b.a) AS k FROM alln n LEFT JOIN both_ends b ON b.g = n.g AND b.a = n.node GROUP BY ALL)"""


def _graph(spark, sf):
    from loomframe.operators.series import positions
    base = positions(table(spark, sf, "customer"), "c_nationkey", "c_custkey", name="node").select(
        F.col("c_nationkey").alias("graph_id"), "node")
    raw = base.select("graph_id", F.col("node").alias("src"), F.explode(
        F.when(F.col("node") % 3 == 0, F.array(F.lit(1), F.lit(7), F.lit(2))).otherwise(F.array(F.lit(1), F.lit(7)))).alias("step"))
    raw = raw.select("graph_id", "src", (F.col("src") + F.col("step")).alias("dst"))
    edges = raw.join(base.withColumnRenamed("node", "dst"), ["graph_id", "dst"]).select("graph_id", "src", "dst")
    lone = base.select("graph_id").distinct().withColumn("node", F.lit(-1).cast("long"))
    return edges, base.unionByName(lone)


@query("g1_degree_stats", f"""{GRAPH}
SELECT g AS graph_id, round(avg(k), 6) AS avg_degree, max(k) AS max_degree FROM deg GROUP BY g""")
def g1(spark, sf):
    return rounded(G.degree_stats(*_graph(spark, sf)), ["avg_degree"])


@query("g2_avg_betweenness", GRAPH.replace("WITH nodes", "WITH RECURSIVE nodes") + """,
bfs(g, s, v, d) AS (SELECT g, node, node, 0 FROM nodes UNION
  SELECT f.g, f.s, b.b, f.d + 1 FROM bfs f JOIN both_ends b ON b.g = f.g AND b.a = f.v WHERE f.d < 40),
dist AS (SELECT g, s, v, min(d) AS d FROM bfs GROUP BY ALL),
t AS (SELECT g, sum(d - 1)::DOUBLE AS s FROM dist WHERE s < v GROUP BY g),
n AS (SELECT g, count(*)::DOUBLE AS n FROM alln GROUP BY g)
SELECT n.g AS graph_id, round(CASE WHEN n > 2 THEN 2 * coalesce(s, 0) / ((n - 1) * (n - 2) * n) ELSE 0 END, 9) AS avg_betweenness
FROM n LEFT JOIN t USING (g)""")
def g2(spark, sf):
    return rounded(G.avg_betweenness(*_graph(spark, sf)), ["avg_betweenness"], 9)


@query("g3_avg_clustering", f"""{GRAPH},
tri AS (SELECT x.g, x.a AS node, count(*) / 2 AS t FROM both_ends x JOIN both_ends y ON y.g = x.g AND y.a = x.a AND y.b <> x.b
        JOIN both_ends z ON z.g = x.g AND z.a = x.b AND z.b = y.b GROUP BY ALL)
SELECT deg.g AS graph_id, round(avg(CASE WHEN k >= 2 THEN 2 * coalesce(t, 0) / (k * (k - 1)) ELSE 0 END), 6) AS avg_clustering
FROM deg LEFT JOIN tri USING (g, node) GROUP BY deg.g""")
def g3(spark, sf):
    return rounded(G.avg_clustering(*_graph(spark, sf)), ["avg_clustering"])


# Weighted bipartite graph of suppliers and parts, as one graph with text nodes.
BIP = """WITH w AS (SELECT 's' || l_suppkey AS s, 'p' || (l_partkey % 50) AS d, count(*)::DOUBLE AS w FROM lineitem GROUP BY ALL),
ends AS (SELECT s, d, w FROM w UNION ALL SELECT d, s, w FROM w),
full_adj AS (SELECT * FROM ends UNION ALL SELECT n, n, 1.0::DOUBLE FROM (SELECT DISTINCT s AS n FROM ends)),
deg AS (SELECT s AS node, greatest(sum(w), 1e-7) AS d FROM full_adj GROUP BY s)"""


def _bipartite(spark, sf):
    w = table(spark, sf, "lineitem").groupBy(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("src"),
        F.concat(F.lit("p"), (F.col("l_partkey") % 50).cast("string")).alias("dst")).agg(F.count("*").cast("double").alias("w"))
    w = w.withColumn("graph_id", F.lit(0))
    ends = w.select("graph_id", "src", "dst", "w").unionByName(
        w.select("graph_id", F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    return ends, ends.select("graph_id", F.col("src").alias("node")).distinct()


def _adjacency(mode, expr):
    sql = f"""{BIP} SELECT 0 AS graph_id, f.s AS src, f.d AS dst, round({expr}, 9) AS w
FROM full_adj f JOIN deg a ON a.node = f.s JOIN deg b ON b.node = f.d"""
    name = {"symmetric": "g4_adjacency_symmetric", "random_walk": "g5_adjacency_random_walk", "right": "g6_adjacency_right"}[mode]

    @query(name, sql)
    def run(spark, sf):
        return rounded(G.normalize_adjacency(*_bipartite(spark, sf), mode), ["w"], 9)


_adjacency("symmetric", "f.w / sqrt(a.d * b.d)")
_adjacency("random_walk", "f.w / a.d")
_adjacency("right", "f.w / b.d")


@query("g7_graph_convolve", f"""{BIP},
x AS (SELECT node, length(node)::DOUBLE AS x0, d / 100 AS x1 FROM deg),
s AS (SELECT f.s AS node, sum(f.w / sqrt(a.d * b.d) * x0) AS s0, sum(f.w / sqrt(a.d * b.d) * x1) AS s1
      FROM full_adj f JOIN deg a ON a.node = f.s JOIN deg b ON b.node = f.d JOIN x ON x.node = f.d GROUP BY f.s)
SELECT 0 AS graph_id, node, round(greatest(0.5 * s0 - 0.2 * s1 + 0.1, 0), 6) + 0.0 AS h0,
  round(greatest(-0.3 * s0 + 0.4 * s1, 0), 6) + 0.0 AS h1 FROM s""")
def g7(spark, sf):
    edges, nodes = _bipartite(spark, sf)
    adj = G.normalize_adjacency(edges, nodes)
    d = edges.groupBy("graph_id", F.col("src").alias("node")).agg(((F.sum("w") + 1) / 100).alias("x1"))
    x = d.withColumn("x0", F.length("node").cast("double"))
    return rounded(G.graph_convolve(adj, x, ["x0", "x1"], [[0.5, -0.3], [-0.2, 0.4]], [0.1, 0.0]), ["h0", "h1"])
