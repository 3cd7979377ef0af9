"""Benchmark decontamination against brute force on planted passages."""

import random
import re
from collections import Counter

from loomframe.llm.decontaminate import contaminated, without_contaminated


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())


def best_similarity(doc, item):
    """Largest similarity over every window of the item's length."""
    k = min(5, len(item))
    size = min(len(doc), len(item))
    want = Counter(tuple(item[i:i + k]) for i in range(len(item) - k + 1))
    best = 0.0
    for s in range(len(doc) - size + 1):
        have = Counter(tuple(doc[s + i:s + i + k]) for i in range(size - k + 1))
        shared = sum((have & want).values())
        if shared:
            best = max(best, shared / (sum(have.values()) + sum(want.values()) - shared))
    return best


def test_every_similar_window_is_found(spark):
    draw = random.Random(4)
    word = lambda: draw.choice("abcdefghij") * draw.randint(1, 3)
    items = [(i, " ".join(word() for _ in range(draw.choice([1, 3, 5, 9, 20, 60])))) for i in range(25)]
    items += [(90, "Twice twice twice twice twice twice twice"), (91, "the same words as another item has here"), (92, "The same, words as another item has here!"),
              (93, None), (94, "  ")]
    docs = []
    for i in range(120):
        text = [word() for _ in range(draw.randint(0, 80))]
        if i % 2:
            part = words(draw.choice(items)[1])
            for _ in range(draw.choice([0, 0, 1, 2])):
                if part:
                    part[draw.randrange(len(part))] = "zz"
            at = draw.choice([0, len(text), draw.randint(0, len(text))])
            text[at:at] = part
        docs.append((i, ", ".join(text).upper() if i % 3 else " ".join(text)))
    docs += [(500, None), (501, ""), (None, "x The same, words as another item HAS here y"), (502, "twice " * 40)]
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    distinct = {}
    for i, t in items:
        if words(t):
            distinct.setdefault(tuple(words(t)), i)
    want = {}
    for d, t in docs:
        for item, i in distinct.items():
            s = best_similarity(words(t), list(item))
            if s >= 0.8:
                want[(d, i)] = s
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert (None, 91) in got


def test_rows_without_leaks_stay(spark, odd, empty):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the river")], "item_id long, text string")
    kept = without_contaminated(odd, bench)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in odd.collect() if r["doc_id"] not in (1, 2))
    assert without_contaminated(odd, bench.filter("false")).count() == odd.count()
    assert contaminated(empty, bench).count() == 0
