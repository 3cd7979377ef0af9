"""Approximate neighbours: recall against brute force, ties, copies and vectors that take no part."""

import numpy as np
from pyspark.sql import functions as F

from loomframe.llm.ann import nearest

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == 8
            and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in good:
        if q % 5 == 0:
            near = sorted((-(np.float64(good[q]) * good[p]).sum(), p) for p in good if p != q)[:k]
            out[q] = [(p, -s) for s, p in near]
    return out


def test_recall_scores_ties_and_odd_vectors(spark):
    draw = np.random.default_rng(1)
    rows = [(i, (draw.normal(size=8) * draw.uniform(0.2, 3)).astype(np.float32).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # a hot vector, also among the queries
    rows += [(5000, None), (5005, [0.0] * 8), (5010, [1.0] * 7 + [None]), (5015, [float("nan")] * 8), (5020, [float("inf")] * 8), (None, [1.0] * 8), (5025, []), (5030, [1.0])]
    rows += [rows[3], rows[5]]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS score", "3 AS v")
    got = {}
    for r in nearest(df, F.col("vec_id") % 5 == 0, 20).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got.setdefault(r["query_id"], [])) + 1
        got[r["query_id"]].append((r["id"], r["score"]))
    want = brute(rows, 20)
    assert got.keys() == want.keys() and all(len(got[q]) == 20 for q in want)
    hits = sum(len({p for p, _ in got[q]} & {p for p, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    exact = {(i): np.array(v, float) for i, v in rows if i in want or i is not None and i < 2000}
    for q, near in got.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0])) and q not in {p for p, _ in near}
        assert all(abs(s - float(exact[q] @ exact[p])) < 1e-12 for p, s in near)
    # copies of the hot vector follow each other from the smallest id, without the query's own
    for q in (1005, 1295):
        hot = [p for p, _ in got[q] if p == 7 or 1000 <= p < 1300]
        assert hot == [p for p in [7, *range(1000, 1300)] if p != q][: len(hot)] and len(hot) > 5


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], SCHEMA)
    assert [(r["query_id"], r["rank"], r["id"]) for r in nearest(df, F.col("vec_id") == 0, 20).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]
    assert nearest(df.filter("vec_id = 0"), F.col("vec_id") == 0, 20).count() == 0
    assert nearest(df.filter("false"), F.lit(True), 20).count() == 0
