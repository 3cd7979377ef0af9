"""Metrics, impurities, curves and feature selection."""

from pyspark.sql import functions as F

from loomframe.catalog.registry import query, rounded, table
from loomframe.operators import metrics as A


def _reg(spark, sf):
    return table(spark, sf, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 2000).alias("pred"))


def _cls(spark, sf):
    rule = F.when(F.col("l_shipdate") > F.lit("1995-06-17").cast("timestamp_ntz"), "O").otherwise("F")
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", rule.alias("pred"))


RULE = "CASE WHEN l_shipdate > TIMESTAMP '1995-06-17' THEN 'O' ELSE 'F' END"
REG = "FROM (SELECT l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem)"


@query("a1_accuracy", f"SELECT round(avg((l_linestatus = {RULE})::INT), 9) AS accuracy FROM lineitem")
def a1(spark, sf):
    return rounded(A.metric_list(_cls(spark, sf), "l_linestatus", "pred", ["accuracy"]), ["accuracy"], 9)


def _one(name, places):
    def run(spark, sf):
        return rounded(A.metric_list(_reg(spark, sf), "l_extendedprice", "pred", [name]), [name], places)
    return run


query("a2_mse", f"SELECT round(avg((y - p) ** 2), 0) AS mse {REG}")(_one("mse", 0))
query("a3_mae", f"SELECT round(avg(abs(y - p)), 4) AS mae {REG}")(_one("mae", 4))
query("a4_r2", f"SELECT round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 9) AS r2 {REG}")(_one("r2", 9))


def _impurity_sql(expr, name, by):
    g = f"{by}, " if by else ""
    over = f"PARTITION BY {by}" if by else ""
    end = f"GROUP BY {by}" if by else ""
    return f"""WITH c AS (SELECT {g}l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL),
p AS (SELECT {g}n / sum(n) OVER ({over}) AS p FROM c) SELECT {g}round({expr}, 9) + 0.0 AS {name} FROM p {end}"""


def _impurity(kind, by=()):
    def run(spark, sf):
        return rounded(A.impurity(table(spark, sf, "lineitem"), "l_linestatus", kind, by), [kind], 9)
    return run


for _id, _kind, _expr in (("a5", "entropy", "-sum(p * log2(p))"), ("a6", "gini", "1 - sum(p * p)"),
                          ("a7", "misclassification", "1 - max(p)")):
    query(f"{_id}_{_kind}", _impurity_sql(_expr, _kind, None))(_impurity(_kind))
    query(f"{_id}_{_kind}_per_group", _impurity_sql(_expr, _kind, "l_returnflag"))(_impurity(_kind, ["l_returnflag"]))


def _gain_sql(expr, out):
    return f"""WITH c AS (SELECT l_returnflag AS s, l_linestatus AS y, count(*) AS n FROM lineitem GROUP BY ALL),
pp AS (SELECT y, sum(n) / (SELECT sum(n) FROM c) AS p FROM c GROUP BY y), parent AS (SELECT {expr} AS i FROM pp),
cp AS (SELECT s, n, n / sum(n) OVER (PARTITION BY s) AS p FROM c),
ch AS (SELECT s, {expr} AS i, sum(n) / (SELECT sum(n) FROM c) AS w FROM cp GROUP BY s),
o AS (SELECT (SELECT i FROM parent) - sum(w * i) AS ig, -sum(w * log2(w)) AS se FROM ch)
SELECT {out} FROM o"""


@query("a8_information_gain_entropy", _gain_sql("-sum(p * log2(p))", "round(ig, 9) AS information_gain"))
def a8(spark, sf):
    out = A.information_gain(table(spark, sf, "lineitem"), "l_linestatus", "l_returnflag")
    return rounded(out.select("information_gain"), ["information_gain"], 9)


@query("a8_information_gain_gini", _gain_sql("1 - sum(p * p)", "round(ig, 9) AS information_gain"))
def a8b(spark, sf):
    out = A.information_gain(table(spark, sf, "lineitem"), "l_linestatus", "l_returnflag", "gini")
    return rounded(out.select("information_gain"), ["information_gain"], 9)


@query("a9_gain_ratio", _gain_sql("-sum(p * log2(p))", "round(ig / se, 9) AS gain_ratio"))
def a9(spark, sf):
    out = A.information_gain(table(spark, sf, "lineitem"), "l_linestatus", "l_returnflag")
    return rounded(out.select("gain_ratio"), ["gain_ratio"], 9)


@query("a10_metric_list", f"""SELECT round(avg(abs(y - p)), 4) AS mae, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 9) AS r2,
round(max(abs(y - p)), 4) AS worst {REG}""")
def a10(spark, sf):
    def worst(y, p):
        return F.max(F.abs(y - p))
    out = A.metric_list(_reg(spark, sf), "l_extendedprice", "pred", ["mae", "r2", worst])
    return rounded(rounded(out, ["mae", "worst"], 4), ["r2"], 9)


BIN = "(SELECT l_quantity / 50 AS s, (l_returnflag = 'R')::INT AS y FROM lineitem)"


def _scored(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_quantity") / 50).alias("s"), (F.col("l_returnflag") == "R").cast("int").alias("y"),
        "l_extendedprice", "l_returnflag", "l_discount", "l_quantity", "l_tax")


@query("a11_roc_curve", f"""WITH g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM {BIN} GROUP BY s)
SELECT s AS threshold, round(sum(pos) OVER w / sum(pos) OVER (), 9) AS tpr, round(sum(neg) OVER w / sum(neg) OVER (), 9) AS fpr
FROM g WINDOW w AS (ORDER BY s DESC)""")
def a11(spark, sf):
    return rounded(A.roc_curve(_scored(spark, sf), "y", "s"), ["tpr", "fpr"], 9)


@query("a12_precision_recall_curve", """WITH g AS (SELECT l_extendedprice AS s, sum((l_returnflag = 'R')::INT) AS pos, count(*) AS n FROM lineitem GROUP BY s)
SELECT s AS threshold, round(sum(pos) OVER w / sum(n) OVER w, 9) AS precision, round(sum(pos) OVER w / sum(pos) OVER (), 9) AS recall
FROM g WINDOW w AS (ORDER BY s DESC)""")
def a12(spark, sf):
    return rounded(A.precision_recall_curve(_scored(spark, sf), "y", "l_extendedprice"), ["precision", "recall"], 9)


@query("a13_weighted_precision_recall_f1", f"""WITH t AS (SELECT l_linestatus AS a, {RULE} AS p FROM lineitem),
k AS (SELECT unnest(['O', 'F']) AS c),
m AS (SELECT c, count(*) FILTER (a = c) AS s, count(*) FILTER (p = c) AS n, count(*) FILTER (a = c AND p = c) AS h FROM t, k GROUP BY c),
x AS (SELECT s, h / n AS pr, h / s AS re FROM m)
SELECT round(sum(s * pr) / sum(s), 9) AS weighted_precision, round(sum(s * re) / sum(s), 9) AS weighted_recall,
  round(sum(s * 2 * pr * re / (pr + re)) / sum(s), 9) AS weighted_f1 FROM x""")
def a13(spark, sf):
    out = A.weighted_scores(_cls(spark, sf), "l_linestatus", "pred")
    return rounded(out, out.columns, 9)


def _auc_sql(src):
    return f"""g AS (SELECT c, s, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY ALL),
k AS (SELECT c, pos, neg, sum(neg) OVER (PARTITION BY c ORDER BY s) - neg AS below FROM g),
a AS (SELECT c, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM k GROUP BY c)
SELECT round(avg(auc), 9) AS roc_auc FROM a"""


@query("a14_roc_auc", f"WITH b AS (SELECT 1 AS c, s, y FROM {BIN}), " + _auc_sql("b"))
def a14(spark, sf):
    return rounded(A.roc_auc(_scored(spark, sf), "y", "s"), ["roc_auc"], 9)


@query("a14_roc_auc_ovr", """WITH b AS (SELECT unnest(['A', 'N', 'R']) AS c, unnest([l_quantity, l_discount, l_tax]) AS s,
  unnest([(l_returnflag = 'A')::INT, (l_returnflag = 'N')::INT, (l_returnflag = 'R')::INT]) AS y FROM lineitem), """ + _auc_sql("b"))
def a14b(spark, sf):
    out = A.roc_auc_ovr(_scored(spark, sf), "l_returnflag", {"A": "l_quantity", "N": "l_discount", "R": "l_tax"})
    return rounded(out, ["roc_auc"], 9)


@query("a15_confusion_matrix", f"""WITH t AS (SELECT l_returnflag AS a, {RULE} AS p, count(*) AS n FROM lineitem GROUP BY ALL),
c AS (SELECT a AS c FROM t UNION SELECT p FROM t), g AS (SELECT x.c AS a, y.c AS p FROM c x, c y),
o AS (SELECT g.a AS actual, g.p AS predicted, coalesce(n, 0) AS n FROM g LEFT JOIN t ON t.a = g.a AND t.p = g.p)
SELECT actual, predicted, n, round(CASE WHEN sum(n) OVER w = 0 THEN 0 ELSE n / sum(n) OVER w END, 9) AS share FROM o WINDOW w AS (PARTITION BY actual)""")
def a15(spark, sf):
    return rounded(A.confusion_matrix(_cls(spark, sf), "l_returnflag", "pred", True), ["share"], 9)


Z = "[l_quantity / 10, l_discount * 50, l_tax * 50]"


@query("a16_cross_entropy", f"""WITH t AS (SELECT {Z} AS z, l_linenumber % 3 AS y FROM lineitem),
p AS (SELECT exp(z[y + 1] - list_max(z)) / (exp(z[1] - list_max(z)) + exp(z[2] - list_max(z)) + exp(z[3] - list_max(z))) AS p FROM t)
SELECT round(avg(-ln(greatest(p, 1e-7))), 8) AS cross_entropy FROM p""")
def a16(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.array(F.col("l_quantity") / 10, F.col("l_discount") * 50, F.col("l_tax") * 50).alias("z"),
        (F.col("l_linenumber") % 3).alias("y"))
    return rounded(A.cross_entropy(df, "z", "y"), ["cross_entropy"], 8)


@query("a17_quadratic_loss", """SELECT round(avg((l_quantity / 10 - l_tax) ** 2 + (l_discount - l_tax) ** 2) / 2, 8) AS quadratic_loss FROM lineitem""")
def a17(spark, sf):
    df = table(spark, sf, "lineitem").select(F.array(F.col("l_quantity") / 10, "l_discount").alias("p"), F.array("l_tax", "l_tax").alias("t"))
    return rounded(A.quadratic_loss(df, "p", "t"), ["quadratic_loss"], 8)


@query("a18_elastic_net_loss", """SELECT round(avg((l_discount - l_tax) ** 2) / 2 + 0.01 * 2 * 0.3 * (0.5 + 1.5) + 0.005 * 2 * 0.7 * (0.25 + 2.25), 9) AS elastic_net_loss FROM lineitem""")
def a18(spark, sf):
    out = A.elastic_net_loss(table(spark, sf, "lineitem"), "l_discount", "l_tax", [0.5, -1.5], 2.0, 0.3)
    return rounded(out, ["elastic_net_loss"], 9)


MI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship"]
MI = """WITH t AS (SELECT l_returnflag AS y, unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'ship']) AS feature,
  unnest([l_quantity, l_extendedprice, l_discount, l_tax, epoch(l_shipdate)::DOUBLE]) AS x FROM lineitem),
m AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM t GROUP BY feature),
b AS (SELECT feature, y, least(floor((x - lo) / ((hi - lo) / 10)), 9) AS b FROM t JOIN m USING (feature)),
j AS (SELECT feature, b, y, count(*) AS n FROM b GROUP BY ALL),
p AS (SELECT feature, n / sum(n) OVER (PARTITION BY feature) AS pxy, sum(n) OVER (PARTITION BY feature, b) / sum(n) OVER (PARTITION BY feature) AS px,
  sum(n) OVER (PARTITION BY feature, y) / sum(n) OVER (PARTITION BY feature) AS py FROM j),
mi AS (SELECT feature, sum(pxy * log2(pxy / (px * py))) AS mi FROM p GROUP BY feature)"""


def _mi(spark, sf):
    seconds = (F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 1e6).alias("ship")
    return table(spark, sf, "lineitem").select("*", seconds)


@query("a19_mutual_information", f"{MI} SELECT feature, round(mi, 8) + 0.0 AS mi FROM mi")
def a19(spark, sf):
    return rounded(A.mutual_information(_mi(spark, sf), MI_COLS, "l_returnflag"), ["mi"], 8)


@query("a20_select_top_features", f"""{MI}, top AS (SELECT feature FROM mi ORDER BY mi DESC LIMIT 2)
SELECT feature, round(x, 2) AS value FROM t SEMI JOIN top USING (feature)""")
def a20(spark, sf):
    df = _mi(spark, sf)
    top = A.select_top_features(df, MI_COLS, "l_returnflag", 2)
    return rounded(df.select(*top).unpivot([], top, "feature", "value"), ["value"], 2)


@query("u3_user_metric", f"SELECT round(quantile_cont(abs(y - p), 0.5), 4) AS median_absolute {REG}")
def u3(spark, sf):
    def median_absolute(y, p):
        return F.percentile(F.abs(y - p), 0.5)
    return rounded(A.metric_list(_reg(spark, sf), "l_extendedprice", "pred", [median_absolute]), ["median_absolute"], 4)


@query("u2_parallel_map", "SELECT o_orderkey, round(sqrt(o_totalprice), 6) AS root FROM orders")
def u2(spark, sf):
    from loomframe.operators.compose import parallel_map
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    out = parallel_map(df, lambda pdf: pdf.assign(root=pdf.o_totalprice ** 0.5)[["o_orderkey", "root"]], "o_orderkey long, root double")
    return rounded(out, ["root"])


@query("u2_parallel_apply", "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS scaled FROM orders")
def u2b(spark, sf):
    import pandas as pd

    from loomframe.operators.compose import parallel_apply

    def scaled(s: pd.Series) -> pd.Series:
        import numpy as np
        return np.log1p(s)

    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(parallel_apply(df, scaled, "o_totalprice", "double", "scaled").drop("o_totalprice"), ["scaled"])
