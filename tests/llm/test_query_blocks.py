"""Points are copied to the query blocks of their own slot, not to all blocks."""

from loomframe.llm import ann


def test_copies_follow_the_visits_of_a_slot(spark, monkeypatch):
    placed = spark.range(1000).selectExpr("id AS point", "array(1D) AS v", "id AS bucket", "CAST(id % 10 AS INT) AS slot")
    # slot 0 is visited by 80 queries, every other slot by 5 of them
    visits = spark.range(80).selectExpr("id AS query", "array(1D) AS v", "array(id) AS buckets", "explode(IF(id < 5, sequence(0, 9), array(0))) AS slot")
    monkeypatch.setattr(ann, "QUERY_BLOCK", 10)
    points, queries = ann.dealt(placed, visits)
    assert points.count() == 900 + 100 * 8 and points.select("point").distinct().count() == 1000
    assert queries.count() == visits.count()
    met = points.join(queries, ["slot", "block"]).select("slot", "point", "query")
    assert met.distinct().count() == met.count() == placed.join(visits, "slot").count()


def test_small_blocks_and_a_failed_fit_give_the_same_or_better(spark, monkeypatch):
    import numpy as np
    x = np.random.default_rng(4).normal(size=(400, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asks = df["vec_id"] % 4 == 0
    rows = lambda: sorted(tuple(r) for r in ann.nearest(df, asks, 5).collect())
    usual = rows()
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    assert rows() == usual
    monkeypatch.setattr(ann, "LEAST", 2.0)  # no fit reaches it: exact
    near = x @ x.T
    np.fill_diagonal(near, -np.inf)
    want = {(q, int(p)) for q in range(0, 400, 4) for p in np.argsort(-near[q])[:5]}
    assert {(r[0], r[2]) for r in rows()} == want
