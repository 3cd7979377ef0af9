"""The pipeline's near-copy stage against plain Python: which documents go and which stay."""

import random

import corpus_pipeline
from loomframe.llm.near_copies import bag_of, links
from loomframe.llm.simhash_dedup import near_duplicates


def alike(a, b):
    def bag(t):
        w = t.lower().split()
        out = {}
        for i in range(max(1, len(w) - 4)):
            s = tuple(w[i:i + 5])
            out[s] = out.get(s, 0) + 1
        return out
    a, b = bag(a), bag(b)
    shared = sum(min(n, b.get(s, 0)) for s, n in a.items())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def planted(draw):
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        base = [draw.choice(words) for _ in range(100)]
        texts.append(" ".join(base))
        for edits in (0, 1, 2, 3, 6):
            w = list(base)
            for _ in range(edits):
                w[draw.randrange(100)] = draw.choice(words)
            texts.append(" ".join(w))
        chain = list(base)  # each copy is near the one before, the last is far from the first
        for i in range(4):
            chain[20 * i + 10] = "other"
            texts.append(" ".join(chain))
    return texts + ["short text", "Short  text", "another short text"]


def test_near_copies_go_and_others_stay(spark):
    texts = planted(random.Random(2))
    group = list(range(len(texts)))
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if alike(texts[i], texts[j]) >= 0.8]
    for i, j in pairs:
        a, b = group[i], group[j]
        group = [min(a, b) if g in (a, b) else g for g in group]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == set(group) and len(kept) < len(texts) / 2


def test_links_are_those_of_the_similarity():
    texts = planted(random.Random(3))[:60]
    label = list(range(len(texts)))
    want = list(label)
    for i in range(len(texts)):
        for j in range(i):
            if alike(texts[i], texts[j]) >= 0.8:
                a, b = want[i], want[j]
                want = [min(a, b) if g in (a, b) else g for g in want]
    for i, j in links([bag_of(t.encode()) for t in texts], 0.8):
        a, b = label[i], label[j]
        label = [min(a, b) if g in (a, b) else g for g in label]
    assert label == want


def test_texts_that_the_simhash_operator_links_are_one(spark):
    """A passage that stands 50 or 80 times: equal fingerprints, bags of a similarity of 0.6. Links of both kinds form one group."""
    draw = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(7))
    many, more = " ".join([passage] * 50), " ".join([passage] * 80)
    near = " ".join([passage] * 77 + ["end"])  # similar to `more` alone
    other = " ".join(draw.choice("abcdefgh") * 3 for _ in range(90))
    assert near_duplicates(spark.createDataFrame([(1, many), (2, more)], "doc_id long, text string")).select("component_id").distinct().count() == 1
    assert alike(many, more) < 0.8 and alike(more, near) >= 0.8 and alike(many, near) < 0.8
    docs = spark.createDataFrame([(5, near), (4, more), (3, many), (9, other), (3, many), (None, more)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == [3, 9]
