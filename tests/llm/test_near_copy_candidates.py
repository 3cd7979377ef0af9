"""Candidates of the near-copy stage: pairs of copies meet, bags that only share passages do not."""

import time

import numpy as np

from loomframe.llm import near_copies
from loomframe.llm.near_copies import BANDS, FAR, candidate_links, keys_of, least_values, sketch_of


def bags_of_similarity(draw, n, size, shared):
    """Bags that have so many values of their size in common with each other."""
    core = draw.integers(0, 1 << 63, shared, dtype=np.uint64) << np.uint64(1)
    return [np.sort(np.concatenate([core, draw.integers(0, 1 << 63, size - shared, dtype=np.uint64) << np.uint64(1)])) for _ in range(n)]


def differing(x, y):
    return np.bitwise_count((sketch_of(x) ^ sketch_of(y)).view(np.uint64)).sum()


def test_copies_meet_and_others_do_not():
    draw = np.random.default_rng(3)
    for size in (9, 50, 500, 5000):
        for _ in range(60):
            a, b = bags_of_similarity(draw, 2, size, int(np.ceil(size * 8 / 9)))  # 8/9 of each shared: similarity 0.8
            x, y = least_values(a), least_values(b)
            assert (keys_of(x) == keys_of(y)).any(), size
            assert differing(x, y) <= FAR
    far = 0
    for _ in range(300):
        a, b = bags_of_similarity(draw, 2, 600, 366)  # similarity 0.44
        far += differing(least_values(a), least_values(b)) > FAR
    assert far >= 290


def test_crowded_keys(spark, monkeypatch):
    """Members of one key are dealt to pairs of parts; families stay connected over parts, strangers apart."""
    draw = np.random.default_rng(5)
    rows, family = [], {}
    for f in range(6):
        base = draw.integers(-1 << 63, 1 << 63, 4, dtype=np.int64)
        for i in range(100):
            fp = f * 1000 + i
            family[fp] = f
            rows.append((fp, [1, 2], (base ^ (np.int64(1) << draw.integers(0, 63, 4))).tolist()))
    table = spark.createDataFrame(rows, "fingerprint long, keys array<long>, sketch array<long>")
    monkeypatch.setattr(near_copies, "CROWD", 50)
    group = {fp: fp for fp in family}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    edges = candidate_links(table).collect()
    for r in edges:
        assert family[r.a] == family[r.b]
        group[top(r.a)] = top(r.b)
    assert len({top(fp) for fp in family}) == 6


def test_a_crowd_of_strangers_takes_seconds():
    """Bags of similarity 0.44 in one key: their sketches tell them apart, so no bag is compared."""
    draw = np.random.default_rng(7)
    sketches = np.array([sketch_of(least_values(b)) for b in bags_of_similarity(draw, 4000, 600, 366)])
    start = time.time()
    a, _ = near_copies.reached(sketches)
    assert time.time() - start < 20 and BANDS == 48
    assert len(a) < 4000


def test_texts_without_words_and_short_ones(odd):
    kept = near_copies.keep_one_near_copy(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 7 in ids and sum(i in (3, 4, 5) for i in ids) == 1
