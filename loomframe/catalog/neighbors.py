"""Neighbors, outliers and kernels on whole embeddings, parts and line items."""

from pyspark.sql import functions as F

from loomframe.catalog.registry import LI_ID_SQL, LI_KEY, query, rounded, table
from loomframe.functions import arrays as A
from loomframe.functions.keys import row_id
from loomframe.operators import kernels as K
from loomframe.operators import neighbors as N
from loomframe.operators import outliers as O

D = "(SELECT a.vec_id AS q, b.vec_id AS p, a.label AS ql, b.label AS pl, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) ** 2))) AS d FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)"
PAIRS = f"""WITH d AS {D}, n AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, p) AS rk FROM d)"""


def _emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", A.doubles("embedding").alias("vec"), "label")


@query("n1_knn_join", f"{PAIRS} SELECT q AS query_id, p AS point_id, round(d, 6) AS distance, rk::INT AS rank FROM n WHERE rk <= 5")
def n1(spark, sf):
    e = _emb(spark, sf)
    return rounded(N.neighbors(e, e, "vec_id", "vec", 5, exclude_self=True), ["distance"])


def _vote(w):
    return f"""{PAIRS}, v AS (SELECT q, pl, sum({w}) AS v FROM n WHERE rk <= 5 GROUP BY ALL)
SELECT q AS query_id, pl AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY q ORDER BY v DESC, pl) = 1"""


@query("n2_knn_classify_uniform", _vote("1"))
def n2(spark, sf):
    e = _emb(spark, sf)
    return N.knn_classify(e, e, "vec_id", "vec", "label", 5, exclude_self=True)


@query("n3_knn_classify_distance", _vote("1 / (d + 2.220446049250313e-16)"))
def n3(spark, sf):
    e = _emb(spark, sf)
    return N.knn_classify(e, e, "vec_id", "vec", "label", 5, "distance", exclude_self=True)


@query("n4_knn_class_probabilities", f"""{PAIRS}, v AS (SELECT q, pl, sum(1 / (d + 2.220446049250313e-16)) AS v FROM n WHERE rk <= 5 GROUP BY ALL),
g AS (SELECT e.vec_id AS q, c.label FROM embeddings e, (SELECT DISTINCT label FROM embeddings) c)
SELECT g.q AS query_id, g.label, round(coalesce(v, 0) / (SELECT sum(v) FROM v x WHERE x.q = g.q), 6) AS p FROM g LEFT JOIN v ON v.q = g.q AND v.pl = g.label""")
def n4(spark, sf):
    e = _emb(spark, sf)
    return rounded(N.knn_class_probabilities(e, e, "vec_id", "vec", "label", 5, "distance", exclude_self=True), ["p"])


def _regress_sql(w):
    return f"{PAIRS} SELECT q AS query_id, round(sum({w} * pl) / sum({w}), 6) AS prediction FROM n WHERE rk <= 5 GROUP BY q"


def _regress(weights):
    def run(spark, sf):
        e = _emb(spark, sf)
        return rounded(N.knn_regress(e, e, "vec_id", "vec", "label", 5, weights, exclude_self=True), ["prediction"])
    return run


query("n5_knn_regress_uniform", _regress_sql("1.0::DOUBLE"))(_regress("uniform"))
query("n5_knn_regress_distance", _regress_sql("(1 / (d + 2.220446049250313e-16))"))(_regress("distance"))

ADAPT = f"""{PAIRS},
v AS (SELECT q, ql, rk, pl, 1 / (d + 2.220446049250313e-16) AS w FROM n WHERE rk <= 11),
s AS (SELECT a.q, a.ql, a.rk AS k, b.pl, sum(b.w) AS s FROM v a JOIN v b ON b.q = a.q AND b.rk <= a.rk GROUP BY ALL),
w AS (SELECT q, ql, k, pl FROM s QUALIFY row_number() OVER (PARTITION BY q, k ORDER BY s DESC, pl) = 1),
b AS (SELECT q, coalesce(min(k) FILTER (pl = ql), 1)::INT AS best_k FROM w GROUP BY q)"""


@query("n6_adaptive_k", f"{ADAPT} SELECT q AS query_id, best_k FROM b")
def n6(spark, sf):
    return N.adaptive_k(_emb(spark, sf), "vec_id", "vec", "label", 1, 12)


@query("n6_adaptive_knn_classify", f"""{ADAPT}, kk AS (SELECT floor(avg(best_k)) AS k FROM b),
x AS (SELECT q, pl, sum(1 / (d + 2.220446049250313e-16)) AS v FROM n, kk WHERE rk <= k GROUP BY ALL)
SELECT q AS query_id, pl AS prediction FROM x QUALIFY row_number() OVER (PARTITION BY q ORDER BY v DESC, pl) = 1""")
def n6b(spark, sf):
    e = _emb(spark, sf)
    return N.adaptive_knn_classify(e, e, "vec_id", "vec", "label", 1, 12, exclude_self=True)


def _lwr_sql(w):
    return f"""WITH q AS (SELECT DISTINCT p_size AS query_id, p_size::DOUBLE AS x FROM part),
t AS (SELECT l_quantity AS x, l_extendedprice AS y, count(*) AS n FROM lineitem GROUP BY ALL),
s AS (SELECT query_id, any_value(q.x) AS qx, sum(n * {w} * t.x * t.x) AS xx, sum(n * {w} * t.x * t.y) AS xy FROM q, t GROUP BY query_id)
SELECT query_id, round(qx * xy / xx, 2) AS prediction FROM s"""


def _lwr(kernel):
    def run(spark, sf):
        q = table(spark, sf, "part").select(F.col("p_size").alias("id"), F.col("p_size").cast("double").alias("x")).distinct()
        p = table(spark, sf, "lineitem").select(row_id(*LI_KEY).alias("id"), F.col("l_quantity").alias("x"), "l_extendedprice")
        return rounded(N.locally_weighted_regress(q, p, "id", ["x"], "l_extendedprice", kernel, 5.0), ["prediction"], 2)
    return run


query("n7_locally_weighted_gaussian", _lwr_sql("exp(-((q.x - t.x) ** 2) / 50)"))(_lwr("gaussian"))
query("n7_locally_weighted_epanechnikov", _lwr_sql("greatest(0, 1 - ((q.x - t.x) / 5) ** 2)"))(_lwr("epanechnikov"))

# prototypes: the mean vector of every label
CENTER = """v AS (SELECT vec_id, label, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
c AS (SELECT label, i, avg(x) AS y FROM v GROUP BY ALL)"""


def _centers(spark, sf):
    e = table(spark, sf, "embeddings").select("label", F.posexplode(A.doubles("embedding")).alias("i", "x"))
    c = e.groupBy("label", "i").agg(F.avg("x").alias("x"))
    return c.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("vec"))


@query("n8_nearest_prototype_classify", f"""WITH {CENTER}, d AS (SELECT vec_id, c.label, sum((x - y) ** 2) AS d FROM v JOIN c USING (i) GROUP BY ALL)
SELECT vec_id AS query_id, label AS prediction FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, label) = 1""")
def n8(spark, sf):
    protos = _centers(spark, sf).withColumn("pid", F.col("label"))
    return N.nearest_prototype_classify(_emb(spark, sf), protos, "vec_id", "vec", "label", "pid")


@query("n9_edited_selection", f"""{PAIRS}, k AS (SELECT q, count(*) FILTER (pl = ql) AS agree FROM n WHERE rk <= 3 GROUP BY q)
SELECT vec_id, label FROM embeddings JOIN k ON q = vec_id WHERE agree > 1.5""")
def n9(spark, sf):
    return N.edited_selection(_emb(spark, sf), "vec_id", "vec", "label").select("vec_id", "label")


@query("n10_condensed_selection")
def n10(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.array(F.col("p_size").cast("double"), F.col("p_retailprice")).alias("vec"),
                                         (F.col("p_retailprice") > 950 + F.col("p_size")).cast("int").alias("label"))
    return N.condensed_selection(df, "p_partkey", "vec", "label").select("p_partkey", "label")


# outliers -----------------------------------------------------------------------------------------

@query("o1_iqr_outliers", f"""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a1, quantile_cont(l_extendedprice, 0.75) AS a3,
  quantile_cont(l_quantity * l_discount, 0.25) AS b1, quantile_cont(l_quantity * l_discount, 0.75) AS b3 FROM lineitem)
SELECT {LI_ID_SQL} AS rid, l_extendedprice < a1 - 1.5 * (a3 - a1) OR l_extendedprice > a3 + 1.5 * (a3 - a1)
  OR l_quantity * l_discount < b1 - 1.5 * (b3 - b1) OR l_quantity * l_discount > b3 + 1.5 * (b3 - b1) AS is_outlier FROM lineitem, q""")
def o1(spark, sf):
    df = table(spark, sf, "lineitem").select(row_id(*LI_KEY).alias("rid"), "l_extendedprice",
                                             (F.col("l_quantity") * F.col("l_discount")).alias("x"))
    return O.iqr_outliers(df, ["l_extendedprice", "x"]).transform(df).select("rid", "is_outlier")


@query("o2_isolation_forest")
def o2(spark, sf):
    df = table(spark, sf, "lineitem").select(row_id(*LI_KEY).alias("rid"), "l_quantity", "l_extendedprice", "l_discount")
    forest = O.IsolationForest(["l_quantity", "l_extendedprice", "l_discount"], n_trees=50).fit(df, "rid")
    return rounded(forest.transform(df).select("rid", "path_length", "is_outlier"), ["path_length"])


LOF = f"""{PAIRS}, t AS (SELECT q, p, d FROM n WHERE rk <= 20), kd AS (SELECT q AS p, max(d) AS kd FROM t GROUP BY q),
lrd AS (SELECT q, 20 / greatest(sum(greatest(d, kd)), 1e-7) AS lrd FROM t JOIN kd USING (p) GROUP BY q),
lof AS (SELECT t.q, avg(b.lrd) / any_value(a.lrd) AS lof FROM t JOIN lrd a ON a.q = t.q JOIN lrd b ON b.q = t.p GROUP BY t.q)"""


@query("o3_local_outlier_factor", f"""{LOF}, th AS (SELECT quantile_cont(lof, 0.9) AS th FROM lof)
SELECT q AS query_id, round(lof, 6) AS lof, lof > th AS is_outlier FROM lof, th""")
def o3(spark, sf):
    fit = O.LocalOutlierFactor("vec", 20).fit(_emb(spark, sf), "vec_id")
    return rounded(fit.result(), ["lof"])


@query("o4_lof_novelty", f"""{LOF}, th AS (SELECT quantile_cont(lof, 0.9) AS th FROM lof),
nq AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * 1.1) AS e FROM embeddings),
nd AS (SELECT a.vec_id AS q, b.vec_id AS p, sqrt(list_sum(list_transform(list_zip(a.e, b.embedding), lambda z: (z[1] - z[2]::DOUBLE) ** 2))) AS d FROM nq a, embeddings b),
nt AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, p) AS rk FROM nd QUALIFY rk <= 20),
nl AS (SELECT q, 20 / greatest(sum(greatest(d, kd)), 1e-7) AS lrd FROM nt JOIN kd USING (p) GROUP BY q),
o AS (SELECT nt.q, avg(b.lrd) / any_value(a.lrd) AS lof FROM nt JOIN nl a ON a.q = nt.q JOIN lrd b ON b.q = nt.p GROUP BY nt.q)
SELECT q AS query_id, round(lof, 6) AS lof, lof > th AS is_outlier FROM o, th""")
def o4(spark, sf):
    e = _emb(spark, sf)
    fit = O.LocalOutlierFactor("vec", 20).fit(e, "vec_id")
    moved = e.withColumn("vec", F.transform("vec", lambda x: x * 1.1))
    return rounded(fit.novelty(moved), ["lof"])


# kernels: all embeddings against the mean vector of every label -----------------------------------

DOTS = f"""WITH {CENTER}, s AS (SELECT vec_id, c.label AS landmark_id, sum(x * y) AS dot, sum((x - y) ** 2) AS d2,
  product(cos(1.5 * (x - y) / 2.0) * exp(-abs(x - y) / 2.0)) AS wave FROM v JOIN c USING (i) GROUP BY ALL),
g AS (SELECT 1 / (64 * var_pop(x)) AS g FROM v)"""


def _kernel(name, **params):
    def run(spark, sf):
        marks = _centers(spark, sf).withColumnRenamed("label", "landmark_id")
        return rounded(K.kernel_matrix(_emb(spark, sf), marks, name, "vec_id", **params), ["k"])
    return run


def _kernel_sql(expr):
    return f"{DOTS} SELECT vec_id, landmark_id, round({expr}, 6) + 0.0 AS k FROM s, g"


query("n11_kernel_linear", _kernel_sql("dot"))(_kernel("linear"))
query("n12_kernel_rbf_scale", _kernel_sql("exp(-g * d2)"))(_kernel("rbf", gamma="scale"))
query("n12_kernel_rbf_auto", _kernel_sql("exp(-d2 / 64)"))(_kernel("rbf", gamma="auto"))
query("n13_kernel_poly", _kernel_sql("(0.5 * dot + 1) ** 3"))(_kernel("poly", gamma=0.5, coef0=1.0, degree=3))
query("n14_kernel_sigmoid", _kernel_sql("tanh(0.5 * dot + 0.1)"))(_kernel("sigmoid", gamma=0.5, coef0=0.1))
query("n15_kernel_rational_quadratic", _kernel_sql("1 - d2 / (d2 + 2.0)"))(_kernel("rational_quadratic", alpha=2.0))
query("n16_kernel_wavelet", _kernel_sql("wave"))(_kernel("wavelet", a=1.5, c=2.0))
query("n17_kernel_frequency_linear", _kernel_sql("64 * dot"))(_kernel("frequency_linear"))


@query("n18_kernel_frequency_rbf", f"""WITH {CENTER}, f AS (SELECT vec_id, c.label AS landmark_id, k,
  sum((x - y) * cos(2 * pi() * ((k * i) % 64) / 64)) AS re, sum((x - y) * sin(2 * pi() * ((k * i) % 64) / 64)) AS im
  FROM v JOIN c USING (i), range(64) t(k) GROUP BY ALL)
SELECT vec_id, landmark_id, k::INT AS frequency, round(exp(-0.3 * (re ** 2 + im ** 2)), 6) AS k FROM f""")
def n18(spark, sf):
    marks = _centers(spark, sf).withColumnRenamed("label", "landmark_id")
    out = K.kernel_matrix(_emb(spark, sf), marks, "frequency_rbf", "vec_id", gamma=0.3)
    return rounded(out.select("vec_id", "landmark_id", F.posexplode("k").alias("frequency", "k")), ["k"])


@query("u4_user_kernel", _kernel_sql("dot / (1 + d2)"))
def u4(spark, sf):
    marks = _centers(spark, sf).withColumnRenamed("label", "landmark_id")
    mine = lambda x, y: A.dot(x, y) / (1.0 + A.squared_distance(x, y))
    return rounded(K.kernel_matrix(_emb(spark, sf), marks, mine, "vec_id"), ["k"])


@query("n19_distance_scaling", """WITH h AS (SELECT embedding, row_number() OVER (ORDER BY md5('42|' || vec_id)) AS i FROM embeddings),
p AS (SELECT a.i AS pair, unnest(range(1, 65)) AS dim, unnest(a.embedding)::DOUBLE AS x, unnest(b.embedding)::DOUBLE AS y FROM h a JOIN h b ON b.i = a.i + 1),
s AS (SELECT dim, sqrt(sum((x - y) ** 2) OVER (PARTITION BY pair ORDER BY dim)) AS d FROM p)
SELECT dim::INT AS dims, round(avg(d), 6) AS mean_distance, round(stddev_pop(d), 6) AS std_distance FROM s GROUP BY dim""")
def n19(spark, sf):
    return rounded(K.distance_scaling(_emb(spark, sf), "vec_id", "vec"), ["mean_distance", "std_distance"])


SUPPORT = f"""{DOTS}, w AS (SELECT vec_id, sum((CASE WHEN landmark_id % 2 = 0 THEN 1 ELSE -1 END) * (landmark_id + 1) / 10.0::DOUBLE * exp(-0.5 * d2)) + 0.05 AS d FROM s GROUP BY vec_id)"""


def _decision(spark, sf):
    marks = _centers(spark, sf).withColumnRenamed("label", "landmark_id")
    sign = F.when(F.col("landmark_id") % 2 == 0, 1).otherwise(-1)
    support = marks.withColumn("coef", sign * (F.col("landmark_id") + 1) / 10.0)
    return K.decision_function(_emb(spark, sf), support, "rbf", 0.05, "vec_id", gamma=0.5)


@query("r13_kernel_decision_function", f"""{SUPPORT}
SELECT vec_id, round(d, 6) + 0.0 AS decision, sign(d)::INT AS prediction, round(1 / (1 + exp(-d)), 6) AS probability FROM w""")
def r13(spark, sf):
    return rounded(_decision(spark, sf), ["decision", "probability"])


@query("q7_margin_decision", f"""{SUPPORT} SELECT vec_id, round(abs(d), 6) AS score FROM w ORDER BY abs(d), vec_id LIMIT 20""")
def q7(spark, sf):
    from loomframe.operators.active import query_margin_decision
    return rounded(query_margin_decision(_decision(spark, sf), "vec_id", "decision", 20), ["score"])


# active selection ---------------------------------------------------------------------------------

@query("q4_density", f"""{PAIRS}, m AS (SELECT q, 1 / (1 + avg(d)) AS s FROM n WHERE rk <= 5 GROUP BY q)
SELECT q AS vec_id, round(s, 6) AS score FROM m ORDER BY s DESC, q LIMIT 20""")
def q4(spark, sf):
    from loomframe.operators.active import query_density
    return rounded(query_density(_emb(spark, sf), "vec_id", "vec", 20, 5), ["score"])
