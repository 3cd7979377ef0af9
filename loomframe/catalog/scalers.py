"""Scalers, encoders, imputers, sources."""

import uuid

from pyspark.sql import functions as F

from loomframe.catalog.registry import LI_KEY, query, rounded, table
from loomframe.operators import encode as E
from loomframe.operators import missing as M
from loomframe.operators import scale as C
from loomframe.operators.fitted import load_fitted, save_fitted
from loomframe.operators.compose import Steps
from loomframe.plans.runtime import ensure_checkpoint_dir
from loomframe.sources import tables as S

KEY = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
X = ["l_quantity", "l_discount", "l_tax", "flat"]


def _li(spark, sf, *more):
    return table(spark, sf, "lineitem").withColumn("flat", F.lit(5.0)).select(*LI_KEY, *X, *more)


def scratch(spark, name):
    """A fresh folder for a write/read round trip, below the checkpoint folder that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def _scale_sql(fit, expr):
    cols = ", ".join(f"round({expr.format(c=c)}, 4) + 0.0 AS {c}" for c in X)
    return f"""WITH t AS (SELECT *, 5.0::DOUBLE AS flat FROM lineitem), f AS (SELECT {fit} FROM t)
SELECT {KEY}, {cols} FROM t, f"""


def _each(template):
    return ", ".join(template.format(c=c) for c in X)


@query("c1_standard_scale", _scale_sql(_each("avg({c}) AS {c}_m, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS {c}_s"),
                                       "({c} - {c}_m) / {c}_s"))
def c1(spark, sf):
    df = _li(spark, sf)
    return rounded(C.standard_scale(df, X).transform(df), X, 4)


@query("c2_minmax_scale", _scale_sql(_each("min({c}) AS {c}_m, CASE WHEN max({c}) = min({c}) THEN 1 ELSE max({c}) - min({c}) END AS {c}_s"),
                                     "({c} - {c}_m) / {c}_s"))
def c2(spark, sf):
    df = _li(spark, sf)
    return rounded(C.minmax_scale(df, X).transform(df), X, 4)


@query("c3_robust_scale", _scale_sql(
    _each("quantile_cont({c}, 0.5) AS {c}_m, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_s"),
    "({c} - {c}_m) / (CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END)"))
def c3(spark, sf):
    df = _li(spark, sf)
    return rounded(C.robust_scale(df, X).transform(df), X, 4)


def _knot_sql(col, refs):
    n = len(refs)
    probs = ", ".join(repr(i / (n - 1)) for i in range(n))
    ref = ", ".join(f"{v!r}::DOUBLE" for v in refs)
    return f"""
WITH k AS (SELECT quantile_cont({col}, [{probs}]) AS q, [{ref}] AS ref FROM lineitem),
j AS (SELECT {KEY}, {col} AS x, q, ref, len(list_filter(q, lambda v: v <= {col})) AS j FROM lineitem, k)
SELECT {KEY}, round(CASE WHEN j = 0 THEN ref[1] WHEN j = {n} THEN ref[{n}]
  ELSE ref[j] + (x - q[j]) / (q[j + 1] - q[j]) * (ref[j + 1] - ref[j]) END, 4) + 0.0 AS {col} FROM j"""


@query("c4_quantile_scale_uniform", _knot_sql("l_extendedprice", [i / 20 for i in range(21)]))
def c4(spark, sf):
    df = table(spark, sf, "lineitem").select(*LI_KEY, "l_extendedprice")
    return rounded(C.quantile_scale(df, ["l_extendedprice"], 21).transform(df), ["l_extendedprice"], 4)


@query("c5_quantile_scale_normal", _knot_sql(
    "l_quantity", [-5.19933758, -0.67448975, 0.0, 0.67448975, 5.19933758]))
def c5(spark, sf):
    df = table(spark, sf, "lineitem").select(*LI_KEY, "l_quantity")
    return rounded(C.quantile_scale(df, ["l_quantity"], 5, "normal").transform(df), ["l_quantity"], 4)


# encoders -----------------------------------------------------------------------------------------

@query("e1_label_encode", """
SELECT o_orderkey, o_orderpriority, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority_code,
  dense_rank() OVER (ORDER BY o_custkey) - 1 AS o_custkey_code FROM orders""")
def e1(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    return E.label_encode(df, ["o_orderpriority", "o_custkey"]).transform(df).drop("o_custkey")


@query("e2_one_hot_encode", f"""
SELECT {KEY}, l_returnflag, l_linestatus, (l_returnflag = 'A')::INT::DOUBLE AS l_returnflag_A, (l_returnflag = 'N')::INT::DOUBLE AS l_returnflag_N,
  (l_linestatus = 'F')::INT::DOUBLE AS l_linestatus_F, (l_linestatus = 'O')::INT::DOUBLE AS l_linestatus_O FROM lineitem""")
def e2(spark, sf):
    df = table(spark, sf, "lineitem").select(*LI_KEY, "l_returnflag", "l_linestatus")
    return E.one_hot_encode(df.filter("l_returnflag <> 'R'"), ["l_returnflag", "l_linestatus"], "ignore").transform(df)


@query("e2_one_hot_rows", """
SELECT p_partkey, 'p_brand' AS feature, dense_rank() OVER (ORDER BY p_brand) - 1 AS idx, 1.0::DOUBLE AS value FROM part
UNION ALL SELECT p_partkey, 'p_type', dense_rank() OVER (ORDER BY p_type) - 1, 1.0::DOUBLE FROM part""")
def e2b(spark, sf):
    return E.one_hot_rows(table(spark, sf, "part"), ["p_partkey"], ["p_brand", "p_type"])


@query("e3_ordinal_encode", f"""
SELECT {KEY}, l_returnflag, l_linestatus, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE -1 END::BIGINT AS l_returnflag_ord,
  CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END::BIGINT AS l_linestatus_ord FROM lineitem""")
def e3(spark, sf):
    df = table(spark, sf, "lineitem").select(*LI_KEY, "l_returnflag", "l_linestatus")
    fit = E.ordinal_encode(df.filter("l_returnflag <> 'R'"), ["l_returnflag", "l_linestatus"],
                           {"l_linestatus": ["O", "F"]}, "ignore")
    return fit.transform(df)


@query("e4_target_encode", f"""
WITH g AS (SELECT avg(l_extendedprice) AS g FROM lineitem WHERE l_returnflag <> 'R'),
t AS (SELECT l_returnflag, (sum(l_extendedprice) + 10 * any_value(g)) / (count(*) + 10) AS te FROM lineitem, g
      WHERE l_returnflag <> 'R' GROUP BY l_returnflag)
SELECT {KEY}, l_returnflag, round(coalesce(te, g), 3) AS l_returnflag_te FROM lineitem CROSS JOIN g LEFT JOIN t USING (l_returnflag)""")
def e4(spark, sf):
    df = table(spark, sf, "lineitem").select(*LI_KEY, "l_returnflag", "l_extendedprice")
    fit = E.target_encode(df.filter("l_returnflag <> 'R'"), ["l_returnflag"], "l_extendedprice")
    return rounded(fit.transform(df).drop("l_extendedprice"), ["l_returnflag_te"], 3)


@query("e5_frequency_encode", """
WITH n AS (SELECT count(*) AS n FROM orders), f AS (SELECT o_custkey, count(*) AS c FROM orders GROUP BY o_custkey)
SELECT o_orderkey, o_custkey, round(c / n, 9) AS o_custkey_freq FROM orders JOIN f USING (o_custkey), n""")
def e5(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return rounded(E.frequency_encode(df, ["o_custkey"]).transform(df), ["o_custkey_freq"], 9)


@query("e6_woe_encode", """
WITH d AS (SELECT doc_id, source, lang, quality FROM documents JOIN labels USING (doc_id)),
w AS (SELECT source, ln((avg(quality) + 1e-7) / (avg(1 - quality) + 1e-7)) AS w FROM d GROUP BY source)
SELECT doc_id, source, round(coalesce(w, 0), 6) + 0.0 AS source_woe FROM documents LEFT JOIN w USING (source)""")
def e6(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    fit = E.woe_encode(docs.join(table(spark, sf, "labels"), "doc_id"), ["source"], "quality")
    return rounded(fit.transform(docs), ["source_woe"])


# missing values -----------------------------------------------------------------------------------

HOLES = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END"


def _holes(spark, sf):
    return table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))


@query("m1_impute_mean", f"""WITH t AS (SELECT event_id, {HOLES} AS value FROM events)
SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM t)), 6) AS value FROM t""")
def m1(spark, sf):
    df = _holes(spark, sf)
    return rounded(M.impute(df, ["value"], "mean").transform(df), ["value"])


@query("m2_impute_median", f"""WITH t AS (SELECT event_id, {HOLES} AS value FROM events)
SELECT event_id, round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM t)), 6) AS value FROM t""")
def m2(spark, sf):
    df = _holes(spark, sf)
    return rounded(M.impute(df, ["value"], "median").transform(df), ["value"])


@query("m3_impute_most_frequent", """
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS p_size,
                  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS p_type FROM part),
a AS (SELECT p_size FROM t WHERE p_size IS NOT NULL GROUP BY p_size ORDER BY count(*) DESC, p_size LIMIT 1),
b AS (SELECT p_type FROM t WHERE p_type IS NOT NULL GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1)
SELECT p_partkey, coalesce(t.p_size, a.p_size) AS p_size, coalesce(t.p_type, b.p_type) AS p_type FROM t, a, b""")
def m3(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 5 != 0, F.col("p_size")).alias("p_size"),
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("p_type"))
    return M.impute(df, ["p_size", "p_type"], "most_frequent").transform(df)


@query("m4_impute_constant", f"SELECT event_id, coalesce({HOLES}, -1.5) AS value FROM events")
def m4(spark, sf):
    df = _holes(spark, sf)
    return M.impute(df, ["value"], "constant", -1.5).transform(df)


M5_SQL = """
WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size::DOUBLE END AS a,
                  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS b, (p_partkey * 37 % 101)::DOUBLE AS c FROM part),
full_rows AS (SELECT * FROM t WHERE a IS NOT NULL AND b IS NOT NULL),
d AS (SELECT t.p_partkey, f.a, f.b, row_number() OVER (PARTITION BY t.p_partkey ORDER BY
        sqrt(coalesce((t.a - f.a) ** 2, 0) + coalesce((t.b - f.b) ** 2, 0) + (t.c - f.c) ** 2), f.p_partkey) AS rk
      FROM t, full_rows f WHERE t.a IS NULL OR t.b IS NULL),
m AS (SELECT p_partkey, avg(a) AS a, avg(b) AS b FROM d WHERE rk <= 5 GROUP BY p_partkey)
SELECT t.p_partkey, round(coalesce(t.a, m.a), 6) AS a, round(coalesce(t.b, m.b), 6) AS b, t.c FROM t LEFT JOIN m USING (p_partkey)"""


@query("m5_knn_impute", M5_SQL)
def m5(spark, sf):
    k = F.col("p_partkey")
    df = table(spark, sf, "part").select(
        "p_partkey", F.when(k % 7 != 0, F.col("p_size").cast("double")).alias("a"),
        F.when(k % 5 != 0, F.col("p_retailprice")).alias("b"), (k * 37 % 101).cast("double").alias("c"))
    return rounded(M.knn_impute(df, "p_partkey", ["a", "b", "c"]), ["a", "b"])


GAPS = """WITH s AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
  CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) % 10 IN (1, 3, 4, 5) THEN NULL ELSE value END AS value FROM events),
n AS (SELECT *, last_value(value IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER b AS pp,
  first_value(value IGNORE NULLS) OVER f AS nv, first_value(CASE WHEN value IS NOT NULL THEN pos END IGNORE NULLS) OVER f AS np FROM s
  WINDOW b AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY user_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
"""


def _gaps(spark, sf):
    from pyspark.sql import Window
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    df = table(spark, sf, "events").withColumn("i", F.row_number().over(w))
    return df.select("event_id", "user_id", "ts", F.when(~(F.col("i") % 10).isin(1, 3, 4, 5), F.col("value")).alias("value"))


def _filled(method, gap=None):
    def run(spark, sf):
        out = M.interpolate(_gaps(spark, sf), "user_id", ["ts", "event_id"], "value", method, gap)
        return rounded(out.select("event_id", "user_id", "value"), ["value"])
    return run


query("m6_interpolate_linear", GAPS + """SELECT event_id, user_id, round(CASE WHEN value IS NOT NULL THEN value WHEN pp IS NULL THEN nv
  WHEN np IS NULL THEN pv ELSE pv + (nv - pv) / (np - pp) * (pos - pp) END, 6) + 0.0 AS value FROM n""")(_filled("linear"))
query("m7_interpolate_forward", GAPS + """SELECT event_id, user_id, round(CASE WHEN value IS NOT NULL THEN value
  WHEN pos - pp <= 2 THEN pv END, 6) + 0.0 AS value FROM n""")(_filled("forward", 2))
query("m8_interpolate_backward", GAPS + """SELECT event_id, user_id, round(CASE WHEN value IS NOT NULL THEN value
  WHEN np - pos <= 1 THEN nv END, 6) + 0.0 AS value FROM n""")(_filled("backward", 1))


# sources ------------------------------------------------------------------------------------------

@query("s1_read_table", "SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice, o_orderpriority FROM orders")
def s1(spark, sf):
    return rounded(S.read_table(spark, f"{sf}/orders.parquet").drop("o_orderdate"), ["o_totalprice"], 2)


def _round_trip(fmt):
    def run(spark, sf):
        df = table(spark, sf, "customer")
        path = scratch(spark, f"customer_{fmt}")
        S.write_table(df, path, fmt)
        back = S.read_table(spark, path, fmt, schema=df.schema)
        return rounded(back, ["c_acctbal"], 2)
    return run


for _fmt in ("parquet", "json", "csv", "orc"):
    query(f"s2_write_table_{_fmt}",
          "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 2) AS c_acctbal, c_mktsegment FROM customer")(_round_trip(_fmt))


@query("s3_labeled_round_trip", """SELECT l_quantity AS f0, l_discount AS f1, l_returnflag AS label, count(*) AS n
FROM lineitem GROUP BY ALL""")
def s3(spark, sf):
    path = scratch(spark, "labeled")
    S.write_labeled(table(spark, sf, "lineitem"), ["l_quantity", "l_discount"], "l_returnflag", path)
    df = S.read_labeled(spark, path)
    return df.groupBy(F.col("features")[0].alias("f0"), F.col("features")[1].alias("f1"), "label").agg(F.count("*").alias("n"))


@query("s4_save_load_fitted", """
WITH n AS (SELECT count(*) AS n FROM orders), f AS (SELECT o_orderpriority, count(*) AS c FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey, o_orderpriority, round(c / n, 9) AS o_orderpriority_freq FROM orders JOIN f USING (o_orderpriority), n""")
def s4(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    path = scratch(spark, "fitted")
    save_fitted(E.frequency_encode(df, ["o_orderpriority"]), path, spark)
    return rounded(load_fitted(spark, path).transform(df), ["o_orderpriority_freq"], 9)


@query("u1_chained_steps", """
WITH t AS (SELECT p_partkey, p_type, coalesce(CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END,
    (SELECT avg(p_retailprice) FROM part WHERE p_partkey % 5 <> 0)) AS p_retailprice FROM part),
s AS (SELECT avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS s FROM t)
SELECT p_partkey, p_type, round((p_retailprice - m) / s, 4) + 0.0 AS p_retailprice,
  dense_rank() OVER (ORDER BY p_type) - 1 AS p_type_code FROM t, s""")
def u1(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey", "p_type", F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice")).alias("p_retailprice"))
    steps = Steps([
        ("fill", lambda d: M.impute(d, ["p_retailprice"])),
        ("scale", lambda d: C.standard_scale(d, ["p_retailprice"])),
        lambda d: E.label_encode(d, ["p_type"]),
    ])
    return rounded(steps.fit_transform(df), ["p_retailprice"], 4)
