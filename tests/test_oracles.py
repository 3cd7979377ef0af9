"""Registered queries against DuckDB, with the plans for large tables forced on small data."""

import pytest

import __spark_entry__ as entry_module
from check_queries import compare, connect

SF = "/root/testdata/sf0.001"
# queries whose operators have a second plan for large input, and one of every other kind
SPLIT = [n for n in entry_module.oracle_sql() if n.startswith(
    ("d", "c", "m", "e1", "e2_one_hot_rows", "e3", "e4", "e5", "w1_", "w2", "w3", "w4", "w5", "w8", "w9", "w10", "w12", "t3",
     "t4", "g2", "g3", "a11", "a12", "a14", "a20", "n1_", "n2", "n6", "n7", "n9", "o1", "o3", "o4", "r14", "r15", "r21", "n19",
     "r13", "r1_", "r9", "v1", "v2", "v4", "q4", "n16", "s4", "u1"))]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", SPLIT)
def test_split_plan_matches_sql(spark, con, split_limits, name):
    text, fine, _ = compare(spark, con, name, SF)
    assert fine, text


def test_every_query_is_callable_and_sql_has_a_query():
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert all(callable(q) for q in queries.values())
    assert set(oracles) <= set(queries)


def test_entry(spark):
    rows = {r["split"]: r for r in entry_module.entry(spark).collect()}
    assert set(rows) == {"train", "val", "test"}
    # the price does not depend on the features in these tables: errors are near the price's own spread
    assert all(r["rmse"] > r["mae"] > 0 and abs(r["r2"]) < 0.1 for r in rows.values())
