"""The mix against brute force."""

import math
import re

from pyspark.sql import functions as F

from loomframe.llm.mixing import mix, mixed_documents, source_targets
from loomframe.llm.mixing import sized


def fill(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        total = sum(w[s] for s in free)
        target = {s: most * sizes[s] if s in full else left * w[s] / total for s in names}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over
        left -= sum(most * sizes[s] for s in over)


def test_targets_equal_water_filling(spark):
    sizes = {"a": 10, "b": 1000, "Z": 30, "é": 500, None: 70, "c": 0, "b2": 5}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(df, [3.0, 1.0, 2.0], 1.5, 2.0).collect()}
    want = fill(sizes, [3.0, 1.0, 2.0], 1.5, 2.0)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


def test_draw_equals_sorting_each_source(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mix(docs, [3.0, 1.0, 2.0], 1.5).collect()
    keys = {r["doc_id"]: r["key"] for r in sized(docs, None, 17, "doc_id", "text", "source").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(texts) and all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]])) for r in rows)
    for source in {r["source"] for r in rows}:
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: (keys[r["doc_id"]], r["doc_id"]))
        size = sum(r["size"] for r in own)
        assert all(r["source_size"] == size for r in own)
        epochs = int(own[0]["target"] // size)
        rest, run = own[0]["target"] - epochs * size, 0
        for r in own:
            after = run + r["size"]
            assert r["copies"] == epochs + (run + after <= 2 * rest) and r["taken"] == r["copies"] * r["size"]
            run = after
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
    again = mix(docs.repartition(7), [3.0, 1.0, 2.0], 1.5).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_documents_of_the_mix_and_odd_rows(spark, odd, empty, stored):
    counts = mix(odd, [3.0, 1.0, 2.0], 1.5)
    assert counts.count() == odd.count() and counts.filter("taken > 2 * size").count() == 0
    out = mixed_documents(stored, [3.0, 1.0, 2.0], 1.5)
    assert out.columns == stored.columns
    taken = mix(stored, [3.0, 1.0, 2.0], 1.5).agg(F.sum("copies")).first()[0]
    assert out.count() == taken
    assert mix(empty, [1.0], 1.5).count() == 0 and mixed_documents(empty, [1.0], 1.5).count() == 0
