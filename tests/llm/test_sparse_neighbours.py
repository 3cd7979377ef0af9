"""Queries whose buckets hold too little are answered exactly."""

import numpy as np
from pyspark.sql import functions as F

from loomframe.llm.ann import nearest


def test_outliers_get_all_their_neighbours(spark):
    draw = np.random.default_rng(6)
    centre = np.eye(16)[0] * 5
    rows = [(i, (centre + draw.normal(size=16) * 0.05).tolist()) for i in range(1, 600)]
    rows += [(1000 + i, (np.eye(16)[1 + i] * (5 if i % 2 else -5)).tolist()) for i in range(15)]  # each far from all others
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, F.col("vec_id") >= 1000, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["id"])
    v = {i: np.array(x) for i, x in rows}
    assert got == {q: sorted((p for p in v if p != q), key=lambda p: (-(v[q] * v[p]).sum(), p))[:20] for q in v if q >= 1000}


def test_few_candidates_are_all_returned(spark):
    draw = np.random.default_rng(7)
    for n in (3, 12, 21):
        rows = [(i, (draw.normal(size=32) * 10.0 ** draw.integers(-2, 3)).tolist()) for i in range(n)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        counts = {r["query_id"]: r["count"] for r in nearest(df, F.lit(True), 20).groupBy("query_id").count().collect()}
        assert counts == {i: n - 1 for i in range(n)}
