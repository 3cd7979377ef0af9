"""Model fits and scoring, evaluation and search, active selection."""

import numpy as np
from pyspark.sql import functions as F

from loomframe.catalog.registry import LI_ID_SQL, LI_KEY, query, r, rounded, table
from loomframe.catalog.splits import poisson_sql
from loomframe.functions import arrays as A
from loomframe.functions.keys import hash_key, key_number, row_id
from loomframe.operators import active as Q
from loomframe.operators import bayes as B
from loomframe.operators import linear as L
from loomframe.operators import scale as C
from loomframe.operators import selection as V
from loomframe.operators import split as D
from loomframe.operators import trees as T
from loomframe.operators.network import NetworkClassifier

X = ["l_quantity", "l_discount", "l_tax"]
LI = f"SELECT {LI_ID_SQL} AS rid, l_quantity AS a, l_discount AS b, l_tax AS c, l_extendedprice AS y, l_returnflag, l_linestatus FROM lineitem"


def _li(spark, sf):
    return table(spark, sf, "lineitem").select(row_id(*LI_KEY).alias("rid"), *X, "l_extendedprice", "l_returnflag", "l_linestatus")


def _solve3(source, ridge="0"):
    """SQL for the 3-feature normal equations by Cramer's rule; source has a, b, c, y."""
    return f"""m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, var_pop(a) + {ridge} AS aa, var_pop(b) + {ridge} AS bb, var_pop(c) + {ridge} AS cc,
  covar_pop(a, b) AS ab, covar_pop(a, c) AS ac, covar_pop(b, c) AS bc, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, covar_pop(c, y) AS cy FROM {source}),
dt AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM m),
w AS (SELECT (ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / det AS wa,
  (aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / det AS wb,
  (aa * (bb * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / det AS wc, ma, mb, mc, my FROM dt)"""


@query("r1_train_and_evaluate", f"""WITH t AS ({LI}), k AS (SELECT *, row_number() OVER (ORDER BY md5('42|' || rid)) AS rk, count(*) OVER () AS n FROM t),
s AS (SELECT *, CASE WHEN rk <= ceil(n * 0.2::DOUBLE) THEN 'test' WHEN rk <= ceil(n * 0.2::DOUBLE) + ceil((n - ceil(n * 0.2::DOUBLE)) * 0.2::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM k),
tr AS (SELECT * FROM s WHERE split = 'train'), {_solve3('tr')},
p AS (SELECT split, y, my + wa * (a - ma) + wb * (b - mb) + wc * (c - mc) AS p FROM s, w)
SELECT split, round(sqrt(avg((y - p) ** 2)), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2 FROM p GROUP BY split""")
def r1_flow(spark, sf):
    """Split, scale, least squares, errors on every part."""
    from loomframe.operators.metrics import mae, mse, r2
    parts = D.split3(_li(spark, sf), "rid")
    train = parts.filter("split = 'train'")
    scaler = C.standard_scale(train, X)
    model = L.linear_fit(scaler.transform(train), X, "l_extendedprice")
    scored = model.transform(scaler.transform(parts))
    y, p = F.col("l_extendedprice"), F.col("prediction")
    return scored.groupBy("split").agg(r(F.sqrt(mse(y, p)), 3).alias("rmse"), r(mae(y, p), 3).alias("mae"), r(r2(y, p)).alias("r2"))


def _weights(fit, spark):
    o = fit.options
    rows = [(c, w) for c, w in zip(o["cols"], o["weights"])] + [("intercept", o["intercept"])]
    return rounded(spark.createDataFrame(rows, "term string, weight double"), ["weight"], 3)


def _fit_sql(ridge):
    return f"""WITH t AS ({LI}), {_solve3('t', ridge)},
o AS (SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'intercept']) AS term, unnest([wa, wb, wc, my - wa * ma - wb * mb - wc * mc]) AS weight FROM w)
SELECT term, round(weight, 3) AS weight FROM o"""


@query("r1_least_squares", _fit_sql("0"))
def r1(spark, sf):
    return _weights(L.linear_fit(_li(spark, sf), X, "l_extendedprice"), spark)


@query("r1_ridge", _fit_sql("0.01::DOUBLE * 2"))
def r1b(spark, sf):
    return _weights(L.linear_fit(_li(spark, sf), X, "l_extendedprice", alpha=2.0), spark)


@query("r1_elastic_net")
def r1c(spark, sf):
    return _weights(L.linear_fit(_li(spark, sf), X, "l_extendedprice", alpha=10.0, l1_ratio=0.5), spark)


def _scaled(spark, sf):
    df = _li(spark, sf).withColumn("y", F.col("l_extendedprice") / 10000)
    return C.standard_scale(df, X).transform(df)


def _descent(method):
    def run(spark, sf):
        df = _scaled(spark, sf)
        fit = L.gradient_fit(df, X, "y", "elastic_net", method, lr=0.05, max_iter=200)
        return rounded(fit.transform(df).select("rid", "prediction"), ["prediction"])
    return run


for _m in ("sgd", "adam"):
    query(f"r3_gradient_fit_{_m}")(_descent(_m))
for _m in ("momentum", "rmsprop", "adagrad"):
    query(f"r4_gradient_fit_{_m}")(_descent(_m))
for _m in ("adamax", "nadam"):
    query(f"r5_gradient_fit_{_m}")(_descent(_m))


@query("r2_gradient_fit_softmax")
def r2(spark, sf):
    df = _scaled(spark, sf)
    fit = L.gradient_fit(df, X, "l_returnflag", "softmax", "adam", lr=0.1, max_iter=10)
    return fit.transform(df).select("rid", "prediction")


@query("r2_gradient_fit_hinge")
def r2b(spark, sf):
    df = _scaled(spark, sf)
    fit = L.gradient_fit(df, X, "l_linestatus", "hinge", "sgd", lr=0.1, max_iter=10)
    return fit.transform(df).select("rid", "prediction")


@query("r6_softmax_classifier")
def r6(spark, sf):
    df = _scaled(spark, sf)
    return L.softmax_classifier(X, "l_returnflag", max_iter=20).fit(df).transform(df).select("rid", "prediction")


@query("r7_softmax_score", f"""WITH t AS ({LI}), z AS (SELECT rid, [0.1037 * a - 2.011 * b + 0.5123, -0.0519 * a + 10.07 * c, 3.003 * b + 3.017 * c + 0.2071] AS z FROM t),
e AS (SELECT rid, z, exp(z[1] - list_max(z)) AS e0, exp(z[2] - list_max(z)) AS e1, exp(z[3] - list_max(z)) AS e2 FROM z)
SELECT rid, round(e0 / (e0 + e1 + e2), 6) AS p0, round(e1 / (e0 + e1 + e2), 6) AS p1, round(e2 / (e0 + e1 + e2), 6) AS p2,
  CASE WHEN z[1] >= z[2] AND z[1] >= z[3] THEN 'A' WHEN z[2] >= z[3] THEN 'N' ELSE 'R' END AS prediction FROM e""")
def r7(spark, sf):
    out = L.softmax_score(_li(spark, sf), X, [[0.1037, -0.0519, 0.0], [-2.011, 0.0, 3.003], [0.0, 10.07, 3.017]], [0.5123, 0.0, 0.2071], ["A", "N", "R"])
    return out.select("rid", *[r(F.col("probabilities")[i]).alias(f"p{i}") for i in range(3)], "prediction")


NB = f"""WITH t AS ({LI}), f AS (SELECT l_returnflag AS class, count(*) / (SELECT count(*) FROM t) AS prior, avg(a) AS ma, var_pop(a) AS va,
 avg(b) AS mb, var_pop(b) AS vb, avg(c) AS mc, var_pop(c) AS vc FROM t GROUP BY l_returnflag)"""


@query("r8_gaussian_nb_fit", f"""{NB} SELECT class, round(prior, 9) AS prior, round(ma, 7) AS m_l_quantity, round(va, 6) AS v_l_quantity,
  round(mb, 9) AS m_l_discount, round(vb, 9) AS v_l_discount, round(mc, 9) AS m_l_tax, round(vc, 9) AS v_l_tax FROM f""")
def r8(spark, sf):
    out = B.gaussian_nb_fit(_li(spark, sf), X, "l_returnflag").tables["params"].df
    out = rounded(rounded(out, ["m_l_quantity"], 7), ["v_l_quantity"], 6)
    return rounded(out, ["prior", "m_l_discount", "v_l_discount", "m_l_tax", "v_l_tax"], 9)


@query("r9_gaussian_nb_score", f"""{NB}, k AS (SELECT *, row_number() OVER () AS u FROM t),
s AS (SELECT u, rid, class, ln(prior) - 0.5 * ln(2 * pi() * va) - (a - ma) ** 2 / (2 * va) - 0.5 * ln(2 * pi() * vb)
  - (b - mb) ** 2 / (2 * vb) - 0.5 * ln(2 * pi() * vc) - (c - mc) ** 2 / (2 * vc) AS s FROM k, f),
e AS (SELECT u, rid, class, s, exp(s - max(s) OVER (PARTITION BY u)) AS e FROM s), p AS (SELECT u, rid, class, s, e / sum(e) OVER (PARTITION BY u) AS p FROM e)
SELECT rid, max(CASE WHEN class = 'A' THEN round(p, 6) END) AS p_a, max(CASE WHEN class = 'N' THEN round(p, 6) END) AS p_n,
  max(CASE WHEN class = 'R' THEN round(p, 6) END) AS p_r, arg_max(class, s) AS prediction FROM p GROUP BY u, rid""")
def r9(spark, sf):
    df = _li(spark, sf)
    out = B.gaussian_nb_fit(df, X, "l_returnflag").transform(df)
    return out.select("rid", *[r(F.col("probabilities")[i]).alias(n) for i, n in enumerate(("p_a", "p_n", "p_r"))], "prediction")


@query("r10_discriminant_fit", f"""WITH t AS ({LI}), l AS (SELECT rid, l_returnflag AS k, unnest(['l_quantity', 'l_discount', 'l_tax']) AS i, unnest([a, b, c]) AS x FROM t),
m AS (SELECT k, i, avg(x) AS m, count(*) AS n FROM l GROUP BY ALL), g AS (SELECT i, avg(x) AS g FROM l GROUP BY i),
d AS (SELECT rid, k, i, x - m AS d FROM l JOIN m USING (k, i)),
sw AS (SELECT p.i, q.i AS j, sum(p.d * q.d) AS within FROM d p JOIN d q ON p.rid = q.rid GROUP BY ALL),
sb AS (SELECT p.i, q.i AS j, sum(p.n * (p.m - gp.g) * (q.m - gq.g)) AS between_ FROM m p JOIN m q ON p.k = q.k JOIN g gp ON gp.i = p.i JOIN g gq ON gq.i = q.i GROUP BY ALL)
SELECT sw.i, sw.j, round(within, 4) + 0.0 AS within, round(between_, 4) + 0.0 AS between FROM sw JOIN sb USING (i, j)""")
def r10(spark, sf):
    return rounded(B.Discriminant(X, "l_returnflag").fit(_li(spark, sf)).scatter(spark), ["within", "between"], 4)


@query("r11_discriminant_transform")
def r11(spark, sf):
    df = _li(spark, sf)
    out = B.Discriminant(X, "l_returnflag").fit(df).transform(df)
    return rounded(out.select("rid", "component_0", "component_1"), ["component_0", "component_1"])


@query("r11_discriminant_predict")
def r11b(spark, sf):
    df = _li(spark, sf)
    return B.Discriminant(X, "l_linestatus").fit(df).predict(df).select("rid", "prediction", r(F.col("probabilities")[0]).alias("p0"))


@query("r12_linear_svm")
def r12(spark, sf):
    df = _scaled(spark, sf)
    return rounded(L.linear_svm(X, "l_linestatus", max_iter=10).fit(df).transform(df).select("rid", "decision", "prediction"), ["decision"], 4)


SP = f"""t AS (SELECT unnest(['l_quantity', 'l_discount', 'l_tax', 'price']) AS feature, unnest([0, 1, 2, 3]) AS fi,
  unnest([l_quantity, l_discount, l_tax, floor(l_extendedprice / 100)]) AS x, (l_returnflag = 'A')::INT AS ka, (l_returnflag = 'N')::INT AS kn, (l_returnflag = 'R')::INT AS kr,
  l_extendedprice / 10000 AS y FROM lineitem)"""
SF = [*X, "price"]


def _split_input(spark, sf):
    return _li(spark, sf).withColumn("price", F.floor(F.col("l_extendedprice") / 100).cast("double")).withColumn(
        "y", F.col("l_extendedprice") / 10000).withColumn("h", F.lit(1.0)).withColumn("g", F.col("y") - 3.8)


def _class_split_sql(imp):
    return f"""WITH {SP}, v AS (SELECT feature, fi, x, sum(ka) AS ka, sum(kn) AS kn, sum(kr) AS kr FROM t GROUP BY ALL),
r AS (SELECT feature, fi, x, sum(ka) OVER w AS la, sum(kn) OVER w AS ln_, sum(kr) OVER w AS lr, sum(ka) OVER z AS ta, sum(kn) OVER z AS tn, sum(kr) OVER z AS tr
  FROM v WINDOW w AS (PARTITION BY fi ORDER BY x), z AS (PARTITION BY fi)),
q AS (SELECT *, (la + ln_ + lr)::DOUBLE AS nl, (ta + tn + tr)::DOUBLE AS n FROM r),
g AS (SELECT feature, fi, x, {imp('ta', 'tn', 'tr', 'n')} - nl / n * ({imp('la', 'ln_', 'lr', 'nl')}) - (n - nl) / n * ({imp('(ta - la)', '(tn - ln_)', '(tr - lr)', '(n - nl)')}) AS gain FROM q WHERE n > nl)
SELECT feature, x AS threshold, round(gain, 9) AS gain FROM g ORDER BY round(gain, 12) DESC, fi, x LIMIT 1"""


def _gini(a, b, c, n):
    return f"(1 - ({a} / {n}) ** 2 - ({b} / {n}) ** 2 - ({c} / {n}) ** 2)"


def _ent(a, b, c, n):
    return "(" + " + ".join(f"CASE WHEN {v} > 0 THEN -({v} / {n}) * log2({v} / {n}) ELSE 0 END" for v in (a, b, c)) + ")"


def _class_split(kind):
    def run(spark, sf):
        return rounded(T.best_split(_split_input(spark, sf), SF, "l_returnflag", kind), ["gain"], 9)
    return run


query("r14_best_split_gini", _class_split_sql(_gini))(_class_split("gini"))
query("r14_best_split_entropy", _class_split_sql(_ent))(_class_split("entropy"))


@query("r15_best_split_regression", f"""WITH {SP}, v AS (SELECT feature, fi, x, count(*) AS n, sum(y) AS s FROM t GROUP BY ALL),
q AS (SELECT feature, x, fi, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER z AS n, sum(s) OVER z AS s FROM v WINDOW w AS (PARTITION BY fi ORDER BY x), z AS (PARTITION BY fi))
SELECT feature, x AS threshold, round(sl * sl / nl + (s - sl) ** 2 / (n - nl) - s * s / n, 4) AS gain FROM q WHERE n > nl ORDER BY 3 DESC, fi, x LIMIT 1""")
def r15(spark, sf):
    return rounded(T.best_split_regression(_split_input(spark, sf), SF, "y"), ["gain"], 4)


@query("r21_best_split_second_order", f"""WITH {SP}, v AS (SELECT feature, fi, x, count(*) AS h, sum(y - 3.8) AS g FROM t GROUP BY ALL),
q AS (SELECT feature, x, fi, sum(h) OVER w AS hl, sum(g) OVER w AS gl, sum(h) OVER z AS h, sum(g) OVER z AS g FROM v WINDOW w AS (PARTITION BY fi ORDER BY x), z AS (PARTITION BY fi))
SELECT feature, x AS threshold, round(gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1), 4) AS gain FROM q WHERE h > hl ORDER BY 3 DESC, fi, x LIMIT 1""")
def r21(spark, sf):
    return rounded(T.best_split_second_order(_split_input(spark, sf), SF, "g", "h"), ["gain"], 4)


@query("r23_gradient_histogram", f"""WITH {SP}, m AS (SELECT feature, min(x) AS lo, (max(x) - min(x)) / 254 AS w FROM t GROUP BY feature)
SELECT feature, (floor((x - lo) / w) + 1)::INT AS bin, round(sum(y - 3.8), 7) + 0.0 AS g, count(*)::DOUBLE AS h FROM t JOIN m USING (feature) GROUP BY ALL""")
def r23(spark, sf):
    return rounded(T.gradient_histogram(_split_input(spark, sf), SF, "g", "h"), ["g"], 7)


@query("r16_decision_tree_classifier")
def r16(spark, sf):
    df = _split_input(spark, sf)
    return T.DecisionTreeClassifier(SF, "l_returnflag", max_depth=3, min_samples_leaf=20).fit(df).transform(df).select(
        "rid", "prediction", r(F.col("probabilities")[0]).alias("p0"))


@query("r17_decision_tree_regressor")
def r17(spark, sf):
    df = _split_input(spark, sf)
    return rounded(T.DecisionTreeRegressor(SF, "y", max_depth=3).fit(df).transform(df).select("rid", "prediction"), ["prediction"])


@query("r18_tree_score", f"""WITH t AS ({LI}) SELECT rid, CASE WHEN a <= 24 THEN CASE WHEN b <= 0.05 THEN 1.5 ELSE 2.5 END ELSE CASE WHEN c <= 0.03 THEN 3.5 ELSE 4.5 END END::DOUBLE AS value FROM t""")
def r18(spark, sf):
    nodes = [(0, "l_quantity", 24.0, 1, 2, None), (1, "l_discount", 0.05, 3, 4, None), (2, "l_tax", 0.03, 5, 6, None),
             (3, None, None, None, None, [1.5]), (4, None, None, None, None, [2.5]), (5, None, None, None, None, [3.5]), (6, None, None, None, None, [4.5])]
    tree = spark.createDataFrame(nodes, "node int, feature string, threshold double, left int, right int, value array<double>")
    return T.tree_score(_li(spark, sf), tree).select("rid", F.col("value")[0].alias("value"))


# Three trees of depth two over l_quantity, l_discount and l_tax, whose values all have bins of their own; two features a node.
_F = "['l_quantity', 'l_discount', 'l_tax']"


def _level(k: int, rows: str) -> str:
    """CTEs: the best split of every node of one level; `rows` has tree, node, w, a, b, c and the class counts ka, kn, kr (weights)."""
    side = "1 - (pow({p}a / n{p}, 2) + pow({p}n / n{p}, 2) + pow({p}r / n{p}, 2))"
    return f"""x{k} AS (SELECT tree, node, unnest([0, 1, 2]) AS f, unnest([a, b, c]) AS x, ka, kn, kr FROM {rows}),
h{k} AS (SELECT tree, node, f, x, sum(ka) AS ka, sum(kn) AS kn, sum(kr) AS kr FROM x{k} GROUP BY ALL),
k{k} AS (SELECT tree, node, f, row_number() OVER (PARTITION BY tree, node ORDER BY md5('42|' || tree || '|' || node || '|' || f)) AS chosen FROM (SELECT DISTINCT tree, node, f FROM h{k})),
l{k} AS (SELECT h.*, sum(ka) OVER u AS la, sum(kn) OVER u AS ln, sum(kr) OVER u AS lr, sum(ka) OVER a AS ta, sum(kn) OVER a AS tn, sum(kr) OVER a AS tr
  FROM h{k} h JOIN k{k} USING (tree, node, f) WHERE chosen <= 2 WINDOW u AS (PARTITION BY tree, node, f ORDER BY x), a AS (PARTITION BY tree, node, f)),
m{k} AS (SELECT *, la + ln + lr AS nl, ta + tn + tr AS nt, ta + tn + tr - la - ln - lr AS nr, ta - la AS ra, tn - ln AS rn, tr - lr AS rr FROM l{k}),
g{k} AS (SELECT *, {side.format(p='t')} - nl / nt * ({side.format(p='l')}) - nr / nt * ({side.format(p='r')}) AS gain FROM m{k} WHERE nl >= 1 AND nr >= 1),
s{k} AS (SELECT tree, node, f, x AS threshold FROM g{k} QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY round(gain, 12) DESC, f, x) = 1)"""


FOREST_SQL = f"""WITH t AS ({LI}),
w AS (SELECT *, unnest([0, 1, 2]) AS tree FROM t),
u AS (SELECT *, ('0x' || substr(md5('42|' || tree || '|' || rid), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM w),
p AS (SELECT *, {{poisson}} AS w FROM u),
r0 AS (SELECT rid, tree, 1 AS node, a, b, c, w * (l_returnflag = 'A')::DOUBLE AS ka, w * (l_returnflag = 'N')::DOUBLE AS kn, w * (l_returnflag = 'R')::DOUBLE AS kr FROM p),
q0 AS (SELECT * FROM r0 WHERE ka + kn + kr > 0),
{_level(0, "q0")},
r1 AS (SELECT r0.* EXCLUDE (node), 2 + ([a, b, c][f + 1] > threshold)::INT AS node FROM r0 JOIN s0 USING (tree)),
q1 AS (SELECT * FROM r1 WHERE ka + kn + kr > 0),
{_level(1, "q1")},
r2 AS (SELECT r1.* EXCLUDE (node), 2 * r1.node + ([a, b, c][f + 1] > threshold)::INT AS node FROM r1 JOIN s1 ON r1.tree = s1.tree AND r1.node = s1.node)"""


@query("r19_random_forest_trees", FOREST_SQL.format(poisson=poisson_sql()) + f"""
SELECT tree::INT AS tree, node::BIGINT AS node, {_F}[f + 1] AS feature, round(threshold, 6) AS threshold FROM s0
UNION ALL SELECT tree::INT, node::BIGINT, {_F}[f + 1], round(threshold, 6) FROM s1""")
def r19_trees(spark, sf):
    fit = T.RandomForest(X, "l_returnflag", "rid", n_trees=3, max_depth=2, max_features=2).fit(_li(spark, sf))
    return rounded(fit.table(spark).filter("feature IS NOT NULL").drop("weights"), ["threshold"])


@query("r19_random_forest_scores", FOREST_SQL.format(poisson=poisson_sql()) + """,
z AS (SELECT tree, node, sum(ka) / sum(ka + kn + kr) AS pa, sum(kn) / sum(ka + kn + kr) AS pn, sum(kr) / sum(ka + kn + kr) AS pr FROM r2 GROUP BY tree, node),
o AS (SELECT rid, avg(pa) AS pa, avg(pn) AS pn, avg(pr) AS pr FROM r2 JOIN z USING (tree, node) GROUP BY rid)
SELECT rid, CASE WHEN round(pa, 9) >= greatest(round(pn, 9), round(pr, 9)) THEN 'A' WHEN round(pn, 9) >= round(pr, 9) THEN 'N' ELSE 'R' END AS prediction, round(pa, 6) AS p0 FROM o""")
def r19_scores(spark, sf):
    df = _li(spark, sf)
    out = T.RandomForest(X, "l_returnflag", "rid", n_trees=3, max_depth=2, max_features=2).fit(df).transform(df)
    return out.select("rid", "prediction", r(F.col("probabilities")[0], 6).alias("p0"))


@query("r19_random_forest_classifier")
def r19(spark, sf):
    df = _split_input(spark, sf)
    out = T.RandomForest(SF, "l_returnflag", "rid", n_trees=10, max_depth=4).fit(df).transform(df)
    return out.select("rid", "prediction", r(F.col("probabilities")[0], 4).alias("p0"))


def _boost(method, **more):
    def run(spark, sf):
        df = _split_input(spark, sf)
        out = T.Boosting(SF, "y", n_trees=3, max_depth=2, learning_rate=0.3, method=method, **more).fit(df, "rid").transform(df)
        return rounded(out.select("rid", "prediction"), ["prediction"])
    return run


query("r20_gradient_boosting_regressor")(_boost("squares", subsample=0.5))
query("r22_second_order_boosting")(_boost("second_order"))
query("r24_histogram_boosting")(_boost("histogram", bins=64))


@query("r25_mlp_classifier")
def r25(spark, sf):
    df = _scaled(spark, sf)
    net = NetworkClassifier(X, "l_returnflag", [6], "rid", batch_size=16384, epochs=2, lr=0.01)
    return net.fit(df).transform(df).select("rid", "prediction")


# A network of two inputs, two hidden units and two classes; one Adam step over all rows as one batch.
NET = [(np.array([[0.3, -0.2], [0.1, 0.4]]), np.array([-0.2137, 0.0103])), (np.array([[0.2, -0.3], [-0.1, 0.25]]), np.array([0.0, 0.05]))]
NET_SQL = """WITH t AS (SELECT l_discount * 10 AS x1, l_quantity / 50 AS x2, (l_linestatus = 'F')::INT AS f, (l_linestatus = 'O')::INT AS o FROM lineitem),
h AS (SELECT *, 0.3::DOUBLE * x1 + 0.1::DOUBLE * x2 - 0.2137::DOUBLE AS z1, -0.2::DOUBLE * x1 + 0.4::DOUBLE * x2 + 0.0103::DOUBLE AS z2 FROM t),
a AS (SELECT *, greatest(z1, 0.01::DOUBLE * z1) AS a1, greatest(z2, 0.01::DOUBLE * z2) AS a2 FROM h),
s AS (SELECT *, exp(0.2::DOUBLE * a1 - 0.1::DOUBLE * a2) AS e1, exp(-0.3::DOUBLE * a1 + 0.25::DOUBLE * a2 + 0.05::DOUBLE) AS e2 FROM a),
d AS (SELECT *, e1 / (e1 + e2) - f AS d1, e2 / (e1 + e2) - o AS d2 FROM s),
u AS (SELECT *, (0.2::DOUBLE * d1 - 0.3::DOUBLE * d2) * CASE WHEN z1 < 0 THEN 0.01::DOUBLE ELSE 1 END AS u1,
             (-0.1::DOUBLE * d1 + 0.25::DOUBLE * d2) * CASE WHEN z2 < 0 THEN 0.01::DOUBLE ELSE 1 END AS u2 FROM d),
g AS (SELECT unnest([0, 0, 0, 0, 0, 0, 1, 1, 1, 1, 1, 1])::INT AS layer, unnest([0, 0, 1, 1, 2, 2, 0, 0, 1, 1, 2, 2])::INT AS input,
             unnest([0, 1, 0, 1, 0, 1, 0, 1, 0, 1, 0, 1])::INT AS output,
             unnest([-0.2137, 0.0103, 0.3, -0.2, 0.1, 0.4, 0.0, 0.05, 0.2, -0.3, -0.1, 0.25])::DOUBLE AS w,
             unnest([avg(u1), avg(u2), avg(x1 * u1), avg(x1 * u2), avg(x2 * u1), avg(x2 * u2),
                     avg(d1), avg(d2), avg(a1 * d1), avg(a1 * d2), avg(a2 * d1), avg(a2 * d2)]) AS gradient FROM u)
SELECT layer, input, output, round(w - 0.01::DOUBLE * gradient / (abs(gradient) + 1e-8::DOUBLE), 6) AS value, round(gradient, 6) AS gradient FROM g"""


@query("r25_mlp_adam_step", NET_SQL)
def r25_step(spark, sf):
    df = _li(spark, sf).select("rid", "l_linestatus", (F.col("l_discount") * 10).alias("x1"), (F.col("l_quantity") / 50).alias("x2"))
    net = NetworkClassifier(["x1", "x2"], "l_linestatus", [2], "rid", batch_size=1 << 40, epochs=1, lr=0.01, layers=NET).fit(df)
    return rounded(net.parameters(spark), ["value", "gradient"])


@query("r25_mlp_held_out", """SELECT count(*) AS n, TRUE AS loss_falls, TRUE AS beats_majority FROM lineitem
WHERE ('0x' || substr(md5('42|' || l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber), 1, 8))::BIGINT % 5 = 0""")
def r25_held_out(spark, sf):
    """A band of l_quantity as the label: no linear rule tells it, and the larger class holds less than nine tenths."""
    number = key_number(hash_key(42, "rid"))
    df = _li(spark, sf).withColumn("band", F.when(F.col("l_quantity").between(17, 34), "in").otherwise("out"))
    df = C.standard_scale(df, X).transform(df)
    aside = df.filter(number % 5 == 0)
    net = NetworkClassifier(["l_quantity"], "band", [8], "rid", batch_size=max(64, df.count() // 8), epochs=12, lr=0.05)
    losses = [h["loss"] for h in net.fit(df.filter(number % 5 != 0)).history]
    right = F.avg((F.col("prediction") == F.col("band")).cast("double")) > F.greatest(F.avg((F.col("band") == "in").cast("double")), F.avg((F.col("band") == "out").cast("double"))) + 0.2
    return net.transform(aside).agg(F.count("*").alias("n"), F.lit(losses[-1] < losses[0] / 2).alias("loss_falls"), right.alias("beats_majority"))


COMMITTEE = """WITH v AS (SELECT o_orderkey, unnest([1, 2, 3]) AS model, o_totalprice AS t, (o_orderkey % 7)::DOUBLE AS u FROM orders),
w AS (SELECT o_orderkey, model, t / 100000 + 1 AS a, u * model / 2 + 1 AS b, 2.0::DOUBLE + model AS c FROM v),
p AS (SELECT o_orderkey, model, unnest([0, 1, 2]) AS class, unnest([a / (a + b + c), b / (a + b + c), c / (a + b + c)]) AS p FROM w)"""


def _committee(spark, sf):
    v = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("model"))
    a, b, c = F.col("o_totalprice") / 100000 + 1, (F.col("o_orderkey") % 7) * F.col("model") / 2 + 1, F.col("model") + 2.0
    s = a + b + c
    return v.select("o_orderkey", "model", F.posexplode(F.array(a / s, b / s, c / s)).alias("class", "p"))


@query("r26_ensemble_average", f"""{COMMITTEE}, q AS (SELECT o_orderkey, model, class AS pred FROM p QUALIFY row_number() OVER (PARTITION BY o_orderkey, model ORDER BY p DESC, class) = 1)
SELECT o_orderkey, round(sum(pred * [0.2, 0.3, 0.5][model]::DOUBLE) / sum([0.2, 0.3, 0.5][model]::DOUBLE), 6) AS prediction FROM q GROUP BY o_orderkey""")
def r26(spark, sf):
    best = _committee(spark, sf).groupBy("o_orderkey", "model").agg(
        F.min(F.struct((-F.col("p")).alias("p"), "class"))["class"].alias("pred"))
    return rounded(V.ensemble_average(best, "o_orderkey", {1: 0.2, 2: 0.3, 3: 0.5}), ["prediction"])


@query("r27_ensemble_soft_vote", f"""{COMMITTEE}, m AS (SELECT o_orderkey, class, sum(p * [0.2, 0.3, 0.5][model]::DOUBLE) AS s FROM p GROUP BY ALL)
SELECT o_orderkey, class AS prediction FROM m QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY round(s, 12) DESC, class) = 1""")
def r27(spark, sf):
    return V.ensemble_soft_vote(_committee(spark, sf), "o_orderkey", {1: 0.2, 2: 0.3, 3: 0.5})


@query("r28_align_domains")
def r28(spark, sf):
    df = _li(spark, sf)
    out = L.align_domains(df.filter("l_linestatus = 'O'"), df.filter("l_linestatus = 'F'"), X)
    return rounded(out.select("rid", *X), X)


@query("w11_harmonic_regression", """WITH t AS (SELECT event_id, value AS y, sin(2 * pi() * x) AS a, cos(2 * pi() * x) AS b FROM
  (SELECT event_id, value, (epoch_us(ts) % 86400000000) / 86400000000 AS x FROM events)),
m AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_ FROM t),
w AS (SELECT *, (ay * bb - ab * by_) / (aa * bb - ab * ab) AS wa, (aa * by_ - ab * ay) / (aa * bb - ab * ab) AS wb FROM m)
SELECT event_id, round(my + wa * (a - ma) + wb * (b - mb), 6) AS prediction FROM t, w""")
def w11(spark, sf):
    day = 86_400_000_000
    x = F.pmod(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(day)) / day
    df = table(spark, sf, "events").select("event_id", "value", x.alias("x"))
    return rounded(L.harmonic_regression(df, "x", "value", frequencies=[0, 1]).transform(df).select("event_id", "prediction"), ["prediction"])


# evaluation and search ----------------------------------------------------------------------------

@query("v1_evaluate", f"""WITH t AS ({LI}), {_solve3('t')}, p AS (SELECT y, my + wa * (a - ma) + wb * (b - mb) + wc * (c - mc) AS p FROM t, w)
SELECT round(avg(abs(y - p)), 4) AS mae, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 8) AS r2 FROM p""")
def v1(spark, sf):
    df = _li(spark, sf)
    out = V.evaluate(L.linear_fit(df, X, "l_extendedprice"), df, "l_extendedprice", ["mae", "r2"])
    return rounded(rounded(out, ["mae"], 4), ["r2"], 8)


def _cv_sql(alphas, final):
    return f"""WITH t AS ({LI}), k AS (SELECT a / 10 AS x, y / 10000 AS y, ntile(5) OVER (ORDER BY md5('42|' || rid)) - 1 AS fold FROM t),
f AS (SELECT unnest(range(5)) AS f), g AS (SELECT unnest({alphas}::DOUBLE[]) AS alpha),
w AS (SELECT f, alpha, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) / (var_pop(x) + 0.01 * alpha) AS w FROM f JOIN k ON fold <> f, g GROUP BY f, alpha),
s AS (SELECT alpha, f AS fold, avg((y - my - w * (x - mx)) ** 2) AS mse, avg(abs(y - my - w * (x - mx))) AS mae,
  1 - sum((y - my - w * (x - mx)) ** 2) / (var_pop(y) * count(*)) AS r2 FROM k JOIN w ON fold = f GROUP BY alpha, f)
{final}"""


def _cv_input(spark, sf):
    return _li(spark, sf).select("rid", (F.col("l_quantity") / 10).alias("x"), (F.col("l_extendedprice") / 10000).alias("y"), "l_returnflag")


@query("v2_cross_validate", _cv_sql([0.0], "SELECT alpha, fold::INT AS fold, round(mse, 8) AS mse, round(mae, 8) AS mae, round(r2, 8) AS r2 FROM s"))
def v2(spark, sf):
    out = V.cross_validate_ridge(_cv_input(spark, sf), ["x"], "rid", "y")
    return rounded(out, ["mse", "mae", "r2"], 8)


@query("v3_cross_validate_table", f"""WITH t AS ({LI}), k AS (SELECT *, ntile(3) OVER (PARTITION BY l_returnflag ORDER BY md5('42|' || rid)) - 1 AS fold FROM t),
f AS (SELECT unnest(range(3)) AS f), n AS (SELECT f, k.l_returnflag AS class, count(*)::DOUBLE AS cnt, avg(a) AS ma, var_pop(a) AS va FROM k JOIN f ON fold <> f GROUP BY ALL),
s AS (SELECT rid, fold, k.l_returnflag, class, ln(cnt / sum(cnt) OVER (PARTITION BY rid)) - 0.5 * ln(2 * pi() * va) - (a - ma) ** 2 / (2 * va) AS s FROM k JOIN n ON f = fold),
p AS (SELECT fold, l_returnflag, arg_max(class, s) AS p FROM s GROUP BY rid, fold, l_returnflag)
SELECT fold::INT AS fold, round(avg((l_returnflag = p)::INT), 8) AS accuracy FROM p GROUP BY fold""")
def v3(spark, sf):
    fit = lambda train: B.gaussian_nb_fit(train, ["l_quantity"], "l_returnflag")
    return rounded(V.cross_validate(fit, _li(spark, sf), "rid", "l_returnflag", ["accuracy"], 3), ["accuracy"], 8)


@query("v4_grid_search", _cv_sql([0.0, 1.0, 10.0, 100.0], "SELECT alpha, round(avg(r2), 8) AS mean_score FROM s GROUP BY alpha"))
def v4(spark, sf):
    scores, _ = V.grid_search_ridge(_cv_input(spark, sf), ["x"], "rid", "y", [0.0, 1.0, 10.0, 100.0])
    return rounded(scores, ["mean_score"], 8)


@query("v5_random_search")
def v5(spark, sf):
    df = _cv_input(spark, sf)
    models = {"ridge": (lambda alpha: (lambda train: L.linear_fit(train, ["x"], "y", alpha)),
                        {"alpha": {"type": "float", "min": 0.0, "max": 10.0}}),
              "net": (lambda alpha, l1_ratio: (lambda train: L.linear_fit(train, ["x"], "y", alpha, l1_ratio)),
                      {"alpha": [0.1, 1.0], "l1_ratio": [0.2, 0.8]})}
    table_, _, _, _ = V.random_search(models, df, "rid", "y", "r2", n_trials=2, k=3)
    return rounded(table_.select("model", "trial", "mean_score"), ["mean_score"], 6)


# active selection ---------------------------------------------------------------------------------

PR = f"WITH t AS ({LI}), u AS (SELECT rid, a + 1 AS x, b * 100 + 1 AS y, c * 100 + 1 AS z FROM t), p AS (SELECT rid, [x / (x + y + z), y / (x + y + z), z / (x + y + z)] AS p FROM u)"


def _pool(spark, sf):
    x, y, z = F.col("l_quantity") + 1, F.col("l_discount") * 100 + 1, F.col("l_tax") * 100 + 1
    s = x + y + z
    return _li(spark, sf).select("rid", F.array(x / s, y / s, z / s).alias("p"))


def _select(strategy):
    def run(spark, sf):
        pool = _pool(spark, sf)
        scored = pool.select("rid", F.round(Q.SCORES[strategy](A.doubles("p")), 9).alias("score"))
        return Q._take(scored, "rid", 50, pool)
    return run


query("q1_uncertainty", f"{PR} SELECT rid, round(1 - list_max(p), 9) AS score FROM p ORDER BY score DESC, rid LIMIT 50")(_select("uncertainty"))
query("q2_entropy", f"{PR} SELECT rid, round(-(p[1] * ln(p[1]) + p[2] * ln(p[2]) + p[3] * ln(p[3])), 9) AS score FROM p ORDER BY score DESC, rid LIMIT 50")(_select("entropy"))
query("q3_margin", f"{PR} SELECT rid, round(1 - (list_reverse_sort(p)[1] - list_reverse_sort(p)[2]), 9) AS score FROM p ORDER BY score DESC, rid LIMIT 50")(_select("margin"))


@query("q5_committee", f"""{COMMITTEE}, s AS (SELECT o_orderkey, class, stddev_pop(p) AS s FROM p GROUP BY ALL)
SELECT o_orderkey, round(avg(s), 9) AS score FROM s GROUP BY o_orderkey ORDER BY avg(s) DESC, o_orderkey LIMIT 50""")
def q5(spark, sf):
    return rounded(Q.query_committee(_committee(spark, sf), "o_orderkey", 50), ["score"], 9)


@query("q6_random", f"WITH t AS ({LI}) SELECT rid FROM t ORDER BY md5('42|' || rid), rid LIMIT 50")
def q6(spark, sf):
    return Q.query_random(_li(spark, sf), "rid", 50)
