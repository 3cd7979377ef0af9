"""Checks, projections and scalar functions."""

from pyspark.sql import functions as F

from loomframe.catalog.registry import LI_KEY, query, r, rounded, table
from loomframe.functions import arrays as A
from loomframe.functions import scalar as S
from loomframe.operators.contract import check_features, check_labeled

KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
P3 = ["l_quantity", "l_discount", "l_tax"]


@query("p1_check_features", """
SELECT c AS column_name, count(*) AS n_rows, count(*) FILTER (v IS NULL) AS n_null,
       count(*) FILTER (isnan(TRY_CAST(v AS DOUBLE))) AS n_nan,
       count(*) FILTER (v IS NOT NULL AND TRY_CAST(v AS DOUBLE) IS NULL) AS n_uncastable
FROM (SELECT unnest(['event_id', 'value', 'event_type', 'ts_text']) AS c,
             unnest([CAST(event_id AS VARCHAR), CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END,
                     event_type, CASE WHEN event_id % 2 = 0 THEN '12' ELSE 'x' END]) AS v FROM events)
GROUP BY c""")
def p1(spark, sf):
    df = table(spark, sf, "events").withColumn(
        "value", F.when(F.col("event_id") % 7 != 0, F.col("value"))).withColumn(
        "ts_text", F.when(F.col("event_id") % 2 == 0, "12").otherwise("x"))
    return check_features(df, ["event_id", "value", "event_type", "ts_text"])


@query("p2_check_labeled", """
SELECT count(*) AS n_rows, count(*) FILTER (quality IS NULL) AS n_unlabeled,
       count(*) FILTER (doc_id IS NULL OR CASE WHEN doc_id % 7 = 0 THEN NULL ELSE n_chars END IS NULL) AS n_incomplete
FROM documents LEFT JOIN labels USING (doc_id)""")
def p2(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    docs = docs.withColumn("n_chars", F.when(F.col("doc_id") % 7 != 0, F.col("n_chars")))
    return check_labeled(docs, ["doc_id", "n_chars"], "quality")


@query("p3_polynomial_features", f"""
SELECT {KEY}, 1.0::DOUBLE AS poly_0, l_quantity AS poly_1, l_discount AS poly_2, l_tax AS poly_3,
  round(l_quantity * l_quantity, 6) AS poly_4, round(l_quantity * l_discount, 6) AS poly_5,
  round(l_quantity * l_tax, 6) AS poly_6, round(l_discount * l_discount, 6) AS poly_7,
  round(l_discount * l_tax, 6) AS poly_8, round(l_tax * l_tax, 6) AS poly_9 FROM lineitem""")
def p3(spark, sf):
    out = S.polynomial_features(table(spark, sf, "lineitem"), P3, 2, keep=LI_KEY)
    return rounded(out, [f"poly_{i}" for i in range(1, 10)])


@query("p3_polynomial_interaction_only", f"""
SELECT {KEY}, 1.0::DOUBLE AS poly_0, l_quantity AS poly_1, l_discount AS poly_2, l_tax AS poly_3,
  round(l_quantity * l_discount, 6) AS poly_4, round(l_quantity * l_tax, 6) AS poly_5,
  round(l_discount * l_tax, 6) AS poly_6, round(l_quantity * l_discount * l_tax, 6) AS poly_7 FROM lineitem""")
def p3b(spark, sf):
    out = S.polynomial_features(table(spark, sf, "lineitem"), P3, 3, True, keep=LI_KEY)
    return rounded(out, [f"poly_{i}" for i in range(1, 8)])


def _interaction(kind):
    def run(spark, sf):
        df = table(spark, sf, "lineitem").select(*LI_KEY, *P3)
        out = S.interaction_features(df, P3, kind)
        made = [c for c in out.columns if f"_{kind}_" in c]
        return rounded(out, made) if kind != "divide" else out
    return run


def _pairs_sql(kind, expr):
    pairs = [("l_quantity", "l_discount"), ("l_quantity", "l_tax"), ("l_discount", "l_tax")]
    cols = ", ".join(f"{expr.format(a=a, b=b)} AS {a}_{kind}_{b}" for a, b in pairs)
    return f"SELECT {KEY}, l_quantity, l_discount, l_tax, {cols} FROM lineitem"


query("p4_interaction_multiply", _pairs_sql("multiply", "round({a} * {b}, 6)"))(_interaction("multiply"))
query("p5_interaction_add", _pairs_sql("add", "round({a} + {b}, 6)"))(_interaction("add"))
query("p6_interaction_subtract", _pairs_sql("subtract", "round({a} - {b}, 6) + 0.0"))(_interaction("subtract"))
query("p7_interaction_divide", _pairs_sql(
    "divide", "{a} / (CASE WHEN {b} = 0 THEN 2.220446049250313e-16::DOUBLE ELSE {b} END)"))(_interaction("divide"))


@query("p8_column_transforms", f"""
SELECT {KEY}, round(CASE WHEN l_quantity > 0 THEN ln(l_quantity) END, 6) AS l_quantity,
  round(CASE WHEN l_discount = 0 THEN NULL ELSE 1 / l_discount END, 6) AS l_discount,
  round(sqrt(l_tax), 6) AS l_tax, round(abs(l_extendedprice - 30000) ** 2, 2) AS l_extendedprice FROM lineitem""")
def p8(spark, sf):
    df = table(spark, sf, "lineitem").select(*LI_KEY, *P3, (F.col("l_extendedprice") - 30000).alias("l_extendedprice"))
    df = S.column_transforms(df, "log", ["l_quantity"])
    df = S.column_transforms(df, "reciprocal", ["l_discount"])
    df = S.column_transforms(df, "sqrt", ["l_tax"])
    df = S.column_transforms(df, ["abs", "square"], ["l_extendedprice"])
    return rounded(rounded(df, P3), ["l_extendedprice"], 2)


@query("p9_column_function", f"""
SELECT {KEY}, round(ln(1 + l_quantity) * 2, 6) AS l_quantity FROM lineitem""")
def p9(spark, sf):
    df = table(spark, sf, "lineitem").select(*LI_KEY, "l_quantity")
    return rounded(S.column_transforms(df, lambda x: F.log1p(x) * 2, ["l_quantity"]), ["l_quantity"])


X_SQL = "(l_quantity - 25) / 10"


def _x():
    return (F.col("l_quantity") - 25) / 10


@query("p10_relu", f"""
SELECT {KEY}, round(greatest({X_SQL}, 0), 6) + 0.0 AS relu,
  round(CASE WHEN {X_SQL} > 0 THEN {X_SQL} ELSE 0.01 * ({X_SQL}) END, 6) + 0.0 AS leaky_relu FROM lineitem""")
def p10(spark, sf):
    return table(spark, sf, "lineitem").select(
        *LI_KEY, r(S.relu(_x())).alias("relu"), r(S.relu(_x(), 0.01)).alias("leaky_relu"))


@query("p11_sigmoid", f"SELECT {KEY}, round(1 / (1 + exp(-({X_SQL}))), 6) AS sigmoid FROM lineitem")
def p11(spark, sf):
    return table(spark, sf, "lineitem").select(*LI_KEY, r(S.sigmoid(_x())).alias("sigmoid"))


@query("p12_tanh", f"SELECT {KEY}, round(tanh({X_SQL}), 6) + 0.0 AS tanh FROM lineitem")
def p12(spark, sf):
    return table(spark, sf, "lineitem").select(*LI_KEY, r(S.tanh(_x())).alias("tanh"))


def _scores():
    return F.array(F.col("l_quantity") / 10, F.col("l_discount") * 50, F.col("l_tax") * 50)


E3 = "exp(l_quantity / 10 - m), exp(l_discount * 50 - m), exp(l_tax * 50 - m)"


@query("p13_softmax", f"""
WITH e AS (SELECT {KEY}, greatest(l_quantity / 10, l_discount * 50, l_tax * 50) AS m, l_quantity, l_discount, l_tax FROM lineitem),
x AS (SELECT {KEY}, exp(l_quantity / 10 - m) AS a, exp(l_discount * 50 - m) AS b, exp(l_tax * 50 - m) AS c FROM e)
SELECT {KEY}, round(a / (a + b + c), 6) AS p0, round(b / (a + b + c), 6) AS p1, round(c / (a + b + c), 6) AS p2 FROM x""")
def p13(spark, sf):
    df = table(spark, sf, "lineitem").select(*LI_KEY, A.softmax(_scores()).alias("p"))
    return df.select(*LI_KEY, *[r(F.col("p")[i]).alias(f"p{i}") for i in range(3)])


@query("p14_argmax_class", f"""
SELECT {KEY}, CASE WHEN l_quantity / 10 >= greatest(l_discount * 50, l_tax * 50) THEN 0
                   WHEN l_discount * 50 >= l_tax * 50 THEN 1 ELSE 2 END AS class FROM lineitem""")
def p14(spark, sf):
    return table(spark, sf, "lineitem").select(*LI_KEY, A.argmax_class(_scores()).alias("class"))


def _successors(spark, sf):
    """Each embedding beside the one with the next id."""
    e = table(spark, sf, "embeddings").select("vec_id", A.doubles("embedding").alias("a"))
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    return e.join(nxt, "vec_id")


SUCC = """WITH v AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
d AS (SELECT a.vec_id, a.i, a.x AS x, b.x AS y FROM v a JOIN v b ON b.vec_id = a.vec_id + 1 AND a.i = b.i)"""


@query("p15_euclidean", f"{SUCC} SELECT vec_id, round(sqrt(sum((x - y) * (x - y))), 6) AS distance FROM d GROUP BY vec_id")
def p15(spark, sf):
    return _successors(spark, sf).select("vec_id", r(A.euclidean(F.col("a"), F.col("b"))).alias("distance"))


@query("p16_euclidean_gradient", f"""{SUCC}, n AS (SELECT vec_id, sqrt(sum((x - y) * (x - y))) AS d FROM d GROUP BY vec_id)
SELECT vec_id, i, round((x - y) / (n.d + 1e-7), 6) + 0.0 AS gradient FROM d JOIN n USING (vec_id)""")
def p16(spark, sf):
    g = _successors(spark, sf).select(
        "vec_id", F.posexplode(A.euclidean_gradient(F.col("a"), F.col("b"))).alias("i", "gradient"))
    return g.select("vec_id", F.col("i").cast("long").alias("i"), r("gradient").alias("gradient"))


@query("p17_signed_distance", """
SELECT p_partkey, round(-1 / sqrt(p_size), 6) + 0.0 AS low, round((p_size - 1) / sqrt(p_size), 6) + 0.0 AS high FROM part""")
def p17(spark, sf):
    low, high = S.signed_distances(F.col("p_size"))
    return table(spark, sf, "part").select("p_partkey", r(low).alias("low"), r(high).alias("high"))


@query("p18_row_normalize", """
WITH v AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings),
m AS (SELECT vec_id, avg(x) AS m, var_pop(x) AS s FROM v GROUP BY vec_id)
SELECT vec_id, i, round((x - m) / sqrt(s + 1e-12), 6) + 0.0 AS value FROM v JOIN m USING (vec_id)""")
def p18(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", A.doubles("embedding").alias("a"))
    e = e.select("vec_id", F.posexplode(A.row_normalize(F.col("a"))).alias("i", "value"))
    return e.select("vec_id", F.col("i").cast("long").alias("i"), r("value").alias("value"))
