"""The pipeline's near-copy stage finds its pairs by SimHash: keys of sure bits, then Hamming distance."""

import tracemalloc

import numpy as np
import pyarrow as pa

from loomframe.llm import near_copies, wide_simhash
from loomframe.llm.language import FEATURED, feature_rows
from loomframe.llm.wide_simhash import CHECKED_FAR, CHECKED_LONGS, FAR, LONGS, has_partner, partnered, sketches_and_keys


def pair(draw, a, b, shared):
    core, rest = (draw.integers(0, 1 << 64, n, dtype=np.uint64) for n in (shared, a + b - 2 * shared))
    return np.concatenate([core, rest[:a - shared]]), np.concatenate([core, rest[a - shared:]])


def distances(x, y):
    return np.bitwise_count((x ^ y).view(np.uint64)).sum(axis=1, dtype=int)


def test_pairs_at_the_limit_meet_and_strangers_are_far():
    draw = np.random.default_rng(3)
    for a, b, shared in ((4, 5, 4), (5, 6, 5), (9, 9, 8), (8, 10, 8), (100, 100, 89), (500, 400, 400)):
        pairs = [pair(draw, a, b, shared) for _ in range(300)]
        (x, keys), (y, others) = (sketches_and_keys([p[i] for p in pairs]) for i in (0, 1))
        assert all(len(np.intersect1d(k, o)) for k, o in zip(keys, others))
        assert distances(x, y).max() <= FAR
        assert distances(x[:, -CHECKED_LONGS:], y[:, -CHECKED_LONGS:]).max() <= CHECKED_FAR
    x, y = (sketches_and_keys([p[i] for p in [pair(draw, 600, 600, 366) for _ in range(300)]])[0] for i in (0, 1))  # similarity 0.44
    assert (distances(x, y) > FAR).mean() > 0.9


def test_a_bit_is_the_sign_of_its_sum():
    bag = np.random.default_rng(4).integers(0, 1 << 64, 700, dtype=np.uint64)
    plain = np.zeros(wide_simhash.BITS, int)
    for v in [*bag, np.uint64(5)]:  # one more value for all
        plain += 2 * np.unpackbits(wide_simhash.value_bits(np.array([v])), axis=1)[0].astype(int) - 1
    sums, n = wide_simhash.bit_sums(bag)
    assert n == 701 and (sums == plain).all()


def rows_of(draw):
    keys, sketches = [], []
    for key in range(60):
        base = draw.integers(-1 << 63, 1 << 63, CHECKED_LONGS, dtype=np.int64)
        for i in range(int(draw.integers(1, 40))):
            keys.append(key)
            near = draw.random() < 0.3
            sketches.append(base ^ (np.int64(1) << draw.integers(0, 63, CHECKED_LONGS)) if near else draw.integers(-1 << 63, 1 << 63, CHECKED_LONGS, dtype=np.int64))
    return np.array(keys), np.array(sketches)


def test_partners_are_those_of_a_plain_comparison(monkeypatch):
    keys, sketches = rows_of(np.random.default_rng(5))
    near = np.bitwise_count((sketches[:, None] ^ sketches[None]).view(np.uint64)).sum(axis=2, dtype=int) <= CHECKED_FAR
    want = (near & (keys[:, None] == keys[None]) & ~np.eye(len(keys), dtype=bool)).any(axis=1)
    assert 0 < want.sum() < len(want)
    assert (has_partner(keys, sketches, CHECKED_FAR) == want).all()
    monkeypatch.setattr(wide_simhash, "SHIFTED", 5)
    assert (has_partner(keys, sketches, CHECKED_FAR) == want).all()


def test_crowded_keys_and_keys_across_batches(spark, monkeypatch):
    keys, sketches = rows_of(np.random.default_rng(6))
    want = {(i, int(keys[i])) for i in np.flatnonzero(has_partner(keys, sketches, CHECKED_FAR))}
    rows = [(i, [int(k)], [0] * (LONGS - CHECKED_LONGS) + s.tolist()) for i, (k, s) in enumerate(zip(keys, sketches))]
    table = spark.createDataFrame(rows, "fingerprint long, keys array<long>, sketch array<long>")
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert {tuple(r) for r in partnered(table, 20_000).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    monkeypatch.setattr(wide_simhash, "SAMPLED", 1)  # all bags tell which keys are crowded: these stay whole
    found = {tuple(r) for r in partnered(table, 2).collect()}
    assert want <= found == {(i, int(k)) for i, k in enumerate(keys) if (keys == k).sum() > 1}


def test_the_stage_goes_by_fingerprints(spark, monkeypatch):
    """With no Hamming distance allowed, edited copies stay and equal bags go."""
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words), " ".join(words).upper(), " ".join([*words[:50], "other", *words[51:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["doc_id"] for r in near_copies.keep_one_near_copy(docs).collect()] == [0]
    monkeypatch.setattr(wide_simhash, "FAR", 0)
    assert sorted(r["doc_id"] for r in near_copies.keep_one_near_copy(docs).collect()) == [0, 2]


def test_sample_rows_take_little_memory():
    n, size = 200, 1000
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * n), pa.array(range(n), pa.int32()), pa.array([np.arange(size, dtype="int32")] * n),
                                        pa.array([np.linspace(0, 1, size, dtype="float32")] * n)], schema=FEATURED)
    tracemalloc.start()
    rows = feature_rows(batch)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < n * size and rows[3][1] == 3 and (rows[3][2] == np.arange(size)).all()
