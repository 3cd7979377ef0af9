"""Splits, folds and samples."""

from loomframe.catalog.registry import LI_ID_SQL, LI_KEY, query, table
from loomframe.functions.keys import row_id
from loomframe.operators import split as D

HASHED = f"WITH t AS (SELECT *, {LI_ID_SQL} AS rid FROM lineitem), h AS (SELECT rid, l_returnflag, md5('42|' || rid) AS k FROM t)"


def _li(spark, sf):
    return table(spark, sf, "lineitem").select(row_id(*LI_KEY).alias("rid"), "l_returnflag")


@query("d1_train_test_split", f"""{HASHED}
SELECT rid, CASE WHEN row_number() OVER (ORDER BY k) <= ceil((SELECT count(*) FROM h) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM h""")
def d1(spark, sf):
    return D.train_test_split(_li(spark, sf), "rid", 0.2).select("rid", "split")


@query("d2_stratified_split", f"""{HASHED}
SELECT rid, l_returnflag, CASE WHEN row_number() OVER (PARTITION BY l_returnflag ORDER BY k)
  <= greatest(1, floor(count(*) OVER (PARTITION BY l_returnflag) * 0.2::DOUBLE)) THEN 'test' ELSE 'train' END AS split FROM h""")
def d2(spark, sf):
    return D.train_test_split(_li(spark, sf), "rid", 0.2, stratify="l_returnflag")


@query("d3_split3", f"""{HASHED}, n AS (SELECT count(*) AS n, ceil(count(*) * 0.2::DOUBLE) AS t FROM h)
SELECT rid, CASE WHEN row_number() OVER (ORDER BY k) <= t THEN 'test'
  WHEN row_number() OVER (ORDER BY k) <= t + ceil((n - t) * 0.2::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM h, n""")
def d3(spark, sf):
    return D.split3(_li(spark, sf), "rid").select("rid", "split")


@query("d4_kfold", f"{HASHED} SELECT rid, (ntile(5) OVER (ORDER BY k) - 1)::INT AS fold FROM h")
def d4(spark, sf):
    return D.kfold(_li(spark, sf), "rid", 5).select("rid", "fold")


@query("d5_stratified_kfold", f"""{HASHED}
SELECT rid, l_returnflag, (ntile(5) OVER (PARTITION BY l_returnflag ORDER BY k) - 1)::INT AS fold FROM h""")
def d5(spark, sf):
    return D.stratified_kfold(_li(spark, sf), "rid", "l_returnflag", 5)


def poisson_sql():
    import math
    total, p, parts = 0.0, math.exp(-1.0), []
    for k in range(16):
        total += p
        parts.append(f"WHEN u < {total!r}::DOUBLE THEN {k}")
        p /= k + 1
    return "CASE " + " ".join(parts) + " ELSE 16 END"


@query("d6_bootstrap", f"""
WITH b AS (SELECT o_orderkey, unnest(range(4))::INT AS bag FROM orders),
u AS (SELECT o_orderkey, bag, ('0x' || substr(md5('42|' || bag || '|' || o_orderkey), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM b)
SELECT o_orderkey, bag, {poisson_sql()} AS weight FROM u WHERE {poisson_sql()} > 0""")
def d6(spark, sf):
    return D.bootstrap(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 4)


@query("d7_subsample", f"""{HASHED}
SELECT rid FROM h QUALIFY row_number() OVER (ORDER BY k) <= floor((SELECT count(*) FROM h) * 0.3::DOUBLE)""")
def d7(spark, sf):
    return D.subsample(_li(spark, sf), "rid", 0.3).select("rid")


@query("d8_balanced_chunks", "SELECT o_orderkey, (ntile(7) OVER (ORDER BY o_orderkey) - 1)::INT AS chunk FROM orders")
def d8(spark, sf):
    return D.balanced_chunks(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 7)
