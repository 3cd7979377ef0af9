"""Topics: equal results whatever the plan, an objective that rises, planted topics, and plain Python loops."""

import hashlib
import math
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomframe.operators.topics import TopicModel

SCHEMA = "id long, t string, word string"


def corpus(spark, n=120):
    """Two planted themes of ten words each, every seventh text a copy of text 0, a NULL and texts without words."""
    rng = random.Random(5)
    themes = [[f"sea{i}" for i in range(10)], [f"sky{i}" for i in range(10)]]
    rows = [(i, " ".join(rng.choice(themes[i % 2]) for _ in range(rng.randint(5, 30))), "own") for i in range(n)]
    rows = [(i, rows[0][1] if i % 7 == 0 else t, w) for i, t, w in rows]
    return spark.createDataFrame([*rows, (n, None, None), (n + 1, "", "x"), (n + 2, "   ", "x")], SCHEMA)


def plain(texts, k, alpha, beta, steps, rounds, seed=42):
    """The same steps, a token count at a time."""
    bags = [{w: t.split().count(w) for w in set(t.split())} for t in texts if t and t.split()]
    words = sorted({w for b in bags for w in b})
    counts = {}
    for w in words:
        u = [(int(hashlib.md5(f"{seed}:{t}:{w}".encode()).hexdigest()[:8], 16) + 1) / 2 ** 32 for t in range(k)]
        total = sum(b.get(w, 0) for b in bags)
        counts[w] = [total * x / sum(u) for x in u]

    def phi():
        below = [sum(c[t] for c in counts.values()) + len(words) * beta for t in range(k)]
        return {w: [(c[t] + beta) / below[t] for t in range(k)] for w, c in counts.items()}

    def move(bag, theta, p):
        told, likelihood = {}, 0.0
        for w, n in bag.items():
            mix = [theta[t] * p[w][t] for t in range(k)]
            likelihood += n * math.log(sum(mix))
            told[w] = [n * m / sum(mix) for m in mix]
        new = [sum(r[t] for r in told.values()) + alpha for t in range(k)]
        return [x / sum(new) for x in new], told, likelihood

    thetas, history = [[1 / k] * k for _ in bags], []
    for _ in range(steps):
        p, total = phi(), 0.0
        fresh = {w: [0.0] * k for w in words}
        for i, bag in enumerate(bags):
            thetas[i], told, likelihood = move(bag, thetas[i], p)
            total += likelihood
            for w, r in told.items():
                fresh[w] = [a + b for a, b in zip(fresh[w], r)]
        counts = fresh
        history.append(total)
    p = phi()
    shares = {}
    for t in texts:
        theta = [1 / k] * k
        if t and t.split():
            for _ in range(rounds):
                theta = move({w: t.split().count(w) for w in set(t.split())}, theta, p)[0]
        shares[t] = theta
    return history, shares, p


@pytest.mark.parametrize("split", [False, True])
def test_equals_plain_loops(spark, split, request):
    if split:  # blocks of 100 words, tables joined by shuffle
        request.getfixturevalue("split_limits")
        spark.conf.set("spark.loomframe.cellRows", "100")
        spark.conf.set("spark.loomframe.broadcastRows", "5")
    df = corpus(spark)
    texts = [r["t"] for r in df.orderBy("id").collect()]
    history, shares, phi = plain(texts, 3, 0.2, 0.05, 4, 6)
    model = TopicModel(3, 0.2, 0.05, max_iter=4, inference_iter=6).fit(df, "t")
    got = [r["log_likelihood"] for r in model.history.orderBy("step").collect()]
    assert got == pytest.approx(history, rel=1e-9)
    out = model.transform(df, "t")
    assert out.columns == ["id", "t", "word", "topics"] and out.count() == df.count()
    for r in out.collect():
        assert r["topics"] == pytest.approx(shares[r["t"]], abs=1e-9)
    best = model.topics(5).collect()
    assert len(best) == 15 and {r["rank"] for r in best} == set(range(5))
    for r in best:
        assert r["weight"] == pytest.approx(phi[r["word"]][r["topic"]], abs=1e-12)
    if split:
        assert not model.vocabulary.small


def test_objective_rises_and_themes_part(spark):
    df = corpus(spark)
    model = TopicModel(2, 0.1, 0.01, max_iter=25).fit(df, "t")
    objective = [r["objective"] for r in model.history.orderBy("step").collect()]
    assert all(b >= a - 1e-9 for a, b in zip(objective, objective[1:])) and objective[-1] > objective[0] + 100
    for t in range(2):
        words = [r["word"][:3] for r in model.topics(10).filter(F.col("topic") == t).collect()]
        assert len(set(words)) == 1
    new = spark.createDataFrame([(1, "sea1 sea2 unknown", ""), (2, "sky3 sky3", ""), (3, "unknown", "")], SCHEMA)
    a, b, c = [r["topics"] for r in model.transform(new, "t").orderBy("id").collect()]
    assert max(a) > 0.9 and max(b) > 0.9 and a.index(max(a)) != b.index(max(b)) and c == [0.5, 0.5]


def test_vocabulary_limits_and_empty_tables(spark):
    df = spark.createDataFrame([(i, f"common rare{i} often{i % 2}", "") for i in range(20)], SCHEMA)
    words = lambda m: {r["word"] for r in m.vocabulary.df.collect()}
    assert words(TopicModel(2, max_iter=1, min_df=2).fit(df, "t")) == {"common", "often0", "often1"}
    assert words(TopicModel(2, max_iter=1, min_df=0.6).fit(df, "t")) == {"common"}
    assert words(TopicModel(2, max_iter=1, vocabulary_size=1).fit(df, "t")) == {"common"}
    empty = TopicModel(2, max_iter=2).fit(df.limit(0), "t")
    assert empty.topics().count() == 0 and empty.log_likelihood(df, "t") == 0.0
    assert {tuple(r["topics"]) for r in empty.transform(df, "t").collect()} == {(0.5, 0.5)}
    with pytest.raises(ValueError):
        TopicModel(2, alpha=0.0)
    with pytest.raises(ValueError):
        TopicModel(2).transform(df, "t")


def test_texts_are_packed_where_they_are_and_steps_leave_nothing(spark):
    """No text is shuffled; of the tables that steps write, only those of the last one stay, however many steps there are."""
    df = corpus(spark).repartition(3)
    blocks, (named, _), parts = TopicModel(3)._blocks(df, "t")
    rows = blocks.collect()
    assert len(rows) == 3 and len({r["block"] for r in rows}) == 3  # a block for each task
    assert parts >= spark.sparkContext.defaultParallelism and named.select("part").distinct().count() <= parts
    TopicModel(2, max_iter=1).fit(df, "t")  # the folder is there now
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    left = []
    for steps in (2, 5):
        before = len(list(folder.iterdir()))
        TopicModel(2, max_iter=steps).fit(df, "t")
        left.append(len(list(folder.iterdir())) - before)
    assert left[0] == left[1]
