"""Packed cells of word pairs against loops, over one cell and over many."""

import collections
import random

import pytest

from loomframe.operators import text as T
from loomframe.operators.pair_cells import pair_cells
from loomframe.plans.runtime import widen


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(6)
    words = [*"abcdefghijkl", "é", "ß", "日本"]
    rows = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(150)] + [None, "", "a", "b b b", "odd a odd2 a"]
    return rows, spark.createDataFrame([(t,) for t in rows], "t string").repartition(5)


@pytest.mark.parametrize("small", [False, True])
def test_cells_equal_loops(spark, texts, small, request):
    if small:
        request.getfixturevalue("split_limits")
    rows, df = texts
    n = collections.Counter()
    for t in rows:
        w = (t or "").split()
        n.update((w[i], w[j]) for i in range(len(w)) for j in range(max(0, i - 4), min(len(w), i + 5)) if i != j)
    kept = T.word_totals(df, "t").filter("total >= 3")
    wanted = {k: c for k, c in n.items() if not {"odd", "odd2"} & set(k)}
    cells = pair_cells(df, "t", kept, 4)
    got = [(r["word"], r["context"], r["n"]) for r in cells.rows("word", "word", "context").collect()]
    assert len(got) == len(wanted) and {(a, b): c for a, b, c in got} == wanted
    assert cells.whole == sum(wanted.values())
    assert (cells.cells.count() > 3) == small


def test_a_table_in_many_tasks_is_not_spread_again(spark):
    many = spark.range(100).repartition(spark.sparkContext.defaultParallelism + 1)
    assert widen(many, 100) is many
    one = spark.range(100).coalesce(1)
    assert widen(one, 100).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
