from itertools import permutations
from math import factorial

from pyspark.sql import functions as F

from loomframe.llm import filter_audit as fa
from loomframe.llm.filter_audit import audit_filters, failures


def plain(rows, labels):
    """The audit by definition: every order applied to every document."""
    good = {i for i, q, t in labels if q == 1 and i is not None}
    toxic = {i for i, q, t in labels if t == 1 and i is not None}
    out = {}
    for doc_id, text, part in rows:
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
        fails = {f for f, bad in zip("ABCD", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words),
            100 * sum("A" <= c <= "Z" for c in text or "") > 3 * len(text or ""), any(c in "#$%&*|" for c in text or ""))) if bad}
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == (text or "") for i, t, _ in rows):
            fails.add("E")
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                row = out.setdefault((part or "", "".join(order), step), [0] * 6)
                row[0] += not gone and f not in fails
                row[1] += not gone and f in fails
                row[2] += gone and f in fails
                row[3] += fails == {f}
                row[4] += not gone and f in fails and doc_id in good
                row[5] += not gone and f in fails and doc_id in toxic
                gone = gone or f in fails
    shapley = {}
    for (part, order, step), row in out.items():
        shapley[part, order[step - 1]] = shapley.get((part, order[step - 1]), 0) + row[1]
    return {(*k, *row, shapley[k[0], k[1][k[2] - 1]]) for k, row in out.items()}


def found(docs, labels):
    out = audit_filters(docs, labels, F.coalesce("lang", F.lit("")))
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {tuple(r) for r in out.collect()}


def test_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert found(docs, labels) == plain([tuple(r) for r in docs.collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])


def test_odd_rows(spark, odd, empty):
    marks = [(1, 1, 0), (1, 0, 0), (1, 1, 1), (2, 1, 1), (7, None, 1), (None, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").withColumn("mask", F.lit(1)).withColumn("text", F.lit("x"))
    assert found(odd, labels) == plain([(r.doc_id, r.text, r.lang) for r in odd.collect()], marks)
    assert found(odd, labels.filter("false")) == plain([(r.doc_id, r.text, r.lang) for r in odd.collect()], [])
    assert found(empty, labels) == set()


def test_pieces_of_long_texts(monkeypatch):
    text = ("Ein Wort mit Größe und # Zeichen \n\t" * 500).encode()
    whole = failures(text)
    monkeypatch.setattr("loomframe.llm.simhash_dedup.PIECE", 64)
    assert failures(text) == whole == 0b1110


def test_potentials(spark):
    """The potential's differences are the mean over all orders, and potentials of a game are efficient."""
    counts = spark.createDataFrame([("p", m, (m * 7) % 11 + 1, 0, 0) for m in range(32)], "part string, mask int, docs long, good long, toxic long")
    row = fa.with_potentials(fa.coalition_worths(counts)).first()
    total = 0
    for i in range(5):
        share = row.potential[31] - row.potential[31 ^ 1 << i]
        sums = 0
        for order in permutations(range(5)):
            before = sum(1 << j for j in order[:order.index(i)])
            sums += row.docs[before | 1 << i] - row.docs[before]
        assert share == sums
        total += share
    assert total == factorial(5) * row.docs[31]


def test_many_copies(spark):
    """One text in a third of all rows."""
    rows = [(i, "same text here" if i % 3 == 0 else f"text {i}", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = audit_filters(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert out.filter("filter_order = 'EABCD' AND step = 1").first().removed == 999
