"""The neighbor join of two large tables: bounds from codes hold, few pairs survive them, and results equal brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomframe.plans import nearest


@pytest.fixture
def blocks(spark):
    spark.conf.set("spark.loomframe.broadcastRows", "10")
    spark.conf.set("spark.loomframe.blockRows", "60")
    yield
    spark.conf.unset("spark.loomframe.broadcastRows")
    spark.conf.unset("spark.loomframe.blockRows")


def tables(spark, q, p):
    def frame(x, name):
        return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], f"{name} long, vec array<double>")

    return frame(q, "query_id"), frame(p, "point_id")


def brute(q, p, k, exclude_self=False):
    out = set()
    for i, row in enumerate(q):
        d = np.sqrt(((p - row) ** 2).sum(axis=1))
        order = sorted((x, j) for j, x in enumerate(d) if not (exclude_self and i == j))[:k]
        out |= {(i, j, rank, round(x, 10)) for rank, (x, j) in enumerate(order, 1)}
    return out


def found(df):
    return {(r.query_id, r.point_id, r["rank"], round(r.distance, 10)) for r in df.collect()}


def unit(rng, n, d=64):
    x = rng.normal(size=(n, d))
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32).astype(float)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    p, q = rng.standard_t(1.5, size=(500, 8)), rng.normal(size=(40, 8))
    levels = nearest.levels_of(p[:100])  # most of the range lies outside the sample
    codes, error = nearest.encode(p, levels)
    rows, cols, low, high = nearest.bounded(q, nearest.decode(codes, levels), error, len(p))
    true = np.sqrt(((q[rows] - p[cols]) ** 2).sum(axis=1))
    assert len(rows) == 40 * 500 and (low <= true).all() and (true <= high).all()


def test_many_dimensions(spark, blocks):
    """Unit vectors of 64 dimensions: no cell can be left out, yet few full vectors are fetched."""
    rng = np.random.default_rng(2)
    q, p = unit(rng, 300), unit(rng, 1500)
    queries, points = tables(spark, q, p)
    assert found(nearest.knn_join(queries, points, 5)) == brute(q, p, 5)
    pairs = nearest.survivors(queries, points, 5, False, len(p)).count()
    assert 300 * 5 <= pairs < 0.05 * len(q) * len(p)
    assert pairs < 300 * 5 * 4


@pytest.mark.parametrize("exclude_self", [False, True])
def test_equal_points_do_not_multiply(spark, blocks, exclude_self):
    """A third of all rows is one point: pairs stay a small multiple of k."""
    rng = np.random.default_rng(3)
    p = rng.normal(size=(900, 3))
    p[::3] = p[0]
    queries, points = tables(spark, p, p)
    assert found(nearest.knn_join(queries, points, 4, exclude_self=exclude_self)) == brute(p, p, 4, exclude_self)
    assert nearest.survivors(queries, points, 4, exclude_self, len(p)).count() < 900 * 4 * 4


def test_outliers_and_constant_dimensions(spark, blocks):
    rng = np.random.default_rng(4)
    p = np.column_stack([rng.normal(size=700), np.ones(700), rng.integers(0, 3, 700)])
    p[5] *= 1e6
    p[6] *= -1e3
    queries, points = tables(spark, p[:200], p)
    assert found(nearest.knn_join(queries, points, 3)) == brute(p[:200], p, 3)


def test_more_wanted_than_a_block_holds(spark, blocks):
    rng = np.random.default_rng(5)
    p = rng.normal(size=(700, 2))
    queries, points = tables(spark, p[:50], p)
    assert found(nearest.knn_join(queries, points, 650)) == brute(p[:50], p, 650)


def test_other_id_types(spark, blocks):
    rng = np.random.default_rng(6)
    p = rng.normal(size=(300, 4))
    queries, points = tables(spark, p[:60], p)
    got = nearest.knn_join(queries.withColumn("query_id", F.concat(F.lit("q"), "query_id")), points.withColumn("point_id", F.concat(F.lit("p"), F.lpad("point_id", 5, "0"))), 3)
    assert {(int(r.query_id[1:]), int(r.point_id[1:]), r["rank"]) for r in got.collect()} == {x[:3] for x in brute(p[:60], p, 3)}


@pytest.mark.parametrize("exclude_self", [False, True])
def test_tiles_equal_brute_force(spark, blocks, monkeypatch, exclude_self):
    """In many dimensions packed blocks meet: no pair leaves a task but the k best of a meeting, ties and repeated points included."""
    rng = np.random.default_rng(7)
    p = unit(rng, 700, 20)
    p[::4] = p[0]
    p[1::50] += 1e4
    monkeypatch.setattr(nearest, "survivors", lambda *a: pytest.fail("codes are for few dimensions"))
    queries, points = tables(spark, p, p)
    near = nearest.knn_join(queries, points, 6, exclude_self=exclude_self)
    got = near.collect()
    want = {(i, rank): (j, d) for i, j, rank, d in brute(p, p, 6, exclude_self)}
    assert {(r.query_id, r["rank"]): r.point_id for r in got} == {key: j for key, (j, d) in want.items()}
    assert max(abs(r.distance - want[r.query_id, r["rank"]][1]) for r in got) < 1e-9
    text = nearest.knn_join(queries.withColumn("query_id", F.concat(F.lit("q"), "query_id")), points.withColumn("point_id", F.format_string("p%05d", "point_id")), 6)
    assert {(int(r.query_id[1:]), r["rank"], int(r.point_id[1:])) for r in text.collect()} == {(i, rank, j) for i, j, rank, _ in brute(p, p, 6)}


def test_best_of_tiles():
    """Rows come in any order, some without a distance; single precision decides nothing."""
    rng = np.random.default_rng(8)
    for d, scale, shift in ((64, 1.0, 0.0), (64, 1e-4, 1e3), (3, 1e-3, 900.0), (20, 1e20, 0.0)):
        p = rng.integers(0, 3, (5000, d)) * scale + shift
        p[7, 0] = np.nan
        order = rng.permutation(5000)
        best = nearest.Best(p[:30], 8, np.arange(30))
        for s in range(0, 5000, 900):
            best.meet(p[order[s:s + 900]], order[s:s + 900])
        rows, ids, dist, _ = best.rows()
        apart = np.sqrt(((p[:30, None, :] - p[None]) ** 2).sum(axis=2))
        apart[np.arange(30), np.arange(30)] = np.nan
        want = [j for i in range(30) if i != 7 for j in np.lexsort((np.arange(5000), apart[i]))[:8]]
        assert ids.tolist() == want
