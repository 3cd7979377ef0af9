"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import xxhash

from loomframe.llm import simhash_dedup as S


def brute_print(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    parts = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    label = list(range(len(prints)))
    near = [[j for j, q in enumerate(prints) if (p ^ q).bit_count() <= 3] for p in prints]
    changed = True
    while changed:
        new = [min(label[j] for j in js) for js in near]
        changed, label = new != label, new
    return label


def test_fingerprint_equals_brute_force_and_pieces_do_not_matter(monkeypatch):
    draw = random.Random(1)
    texts = ["", "a", "a b", "A b C", " x\ty\nz\x0bq\x0cr\rs ", "  a b c", "é É ß"]
    texts += [" ".join(draw.choice("ab cd ef GH é").strip() or "x" for _ in range(draw.randint(1, 60))) for _ in range(60)]
    for size in (S.PIECE, 16, 1):
        monkeypatch.setattr(S, "PIECE", size)
        assert [S.fingerprint(t.encode()) for t in texts] == [brute_print(t) for t in texts]


def test_components_by_pivots_equal_brute_force():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 40, dtype=np.uint64)
    prints = [int(x) for x in base]
    for x in base[:20]:
        for _ in range(12):
            for b in draw.integers(0, 64, draw.integers(1, 5)):
                x = x ^ np.uint64(1 << int(b))
            prints.append(int(x))
    fps = np.unique(np.array(prints, dtype=np.uint64))
    want = fps[np.array(brute_components([int(f) for f in fps]))]
    assert (S.components_of(fps, 3) == want).all()


def test_links_meet_in_keys_and_crowds_are_dealt_out(spark, monkeypatch):
    draw = np.random.default_rng(5)
    rows = set()
    for seed in draw.integers(0, 2**63, 30, dtype=np.uint64):
        x = int(seed)
        for _ in range(15):
            x ^= sum(1 << int(b) for b in draw.integers(0, 64, 3))
            rows.add(x)
    prints = sorted(rows)
    want = {prints[i]: prints[j] for i, j in enumerate(brute_components(prints))}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    for crowd in (20_000, 4):
        # the limit reaches the workers through the function's own module state only in this process, so it is tested directly too
        monkeypatch.setattr(S, "CROWD", crowd)
        found = S._edges(np.array(prints, dtype=np.uint64), list(range(64)), 3)
        label = {p: p for p in prints}
        for a, b in [(int(x), int(y)) for m, r in found for x, y in zip(m, r)]:
            old, new = label[a], label[b]
            label = {k: (min(old, new) if v in (old, new) else v) for k, v in label.items()}
        assert label == want
    got = {r["fingerprint"]: r["component"] for r in S.near_duplicate_map(df).collect()}
    groups = {}
    for p in prints:
        groups.setdefault(want[p], set()).add(p)
    mine = {}
    for s, c in got.items():
        mine.setdefault(c, set()).add(s % (1 << 64))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_long_chain_is_one_component(spark):
    x, chain = 0, [0]
    for b in range(0, 60, 2):
        x |= 3 << b
        chain.append(x)
    df = spark.createDataFrame([(c,) for c in chain], "fingerprint long")
    assert {r["component"] for r in S.near_duplicate_map(df).collect()} == {0}


def test_odd_rows(spark, odd, empty, stored):
    rows = S.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[2]["component_id"] == 1 and by[3]["fingerprint"] == "0" * 16
    assert by[3]["component_id"] == by[4]["component_id"] == by[5]["component_id"] == 3
    assert S.near_duplicates(empty).count() == 0
    kept = S.keep_one(stored)
    assert kept.columns == stored.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 3, 6, 7, 8] and ids.count(None) == 1
    assert S.keep_one(empty).count() == 0
