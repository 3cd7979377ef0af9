import re
import zlib
from collections import Counter

import pytest

from loomframe.llm import spelling
from loomframe.llm.queries.spellings import op11


def plain(rows):
    """The whole query by definition: near words by comparing all with all."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    partners = {w: [v for d in (-1, 0, 1) for v in by_length.get(len(w) + d, []) if near(w, v)] for w in n}
    best = {w: min(p, key=lambda v: (-n[v], v)) for w, p in partners.items() if p}
    form = {w: v for w, v in best.items() if n[v] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(partners[w]), n[form[w]] if w in form else None) for w in n}


def found(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_query_by_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = op11(spark, sf)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(out) == plain(rows)
    assert out.count() == len(plain(rows))


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_ranges_share_nodes(spark, ranges):
    """Dense words over few letters: prefixes and suffixes that go on over many ranges, runs of equal letters, chains of forms."""
    from itertools import product

    words = ["".join(p) for n in (6, 7) for p in product("ab", repeat=n)] + ["aaaaaaaa" + "a" * k for k in range(30)] + ["ébéébé", "bébébé", "ébébéb"]
    rows = [(i, " ".join([w] * (5 ** (1 + i % 4)))) for i, w in enumerate(words)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spelling.spelling_groups(df)) == plain(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_node_numbers(spark):
    words = ["a", "ab", "abc", "abd", "b", "ba", "éa", "aé"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spelling.numbered(spark.createDataFrame([(w,) for w in words], "word string"), "word").collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    prefixes = {}
    for r in rows:
        for d, node in enumerate(r.path):
            prefixes.setdefault(node, set()).add(r.word[:d])
    assert all(len(p) == 1 for p in prefixes.values())
    assert len(prefixes) == len({w[:d] for w in words for d in range(len(w) + 1)})
    assert [r.word for r in sorted(rows, key=lambda r: r.place)] == sorted(words)


def test_sums_are_passed_on(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    whole = {tuple(r) for r in spelling.word_counts(docs).collect()}
    monkeypatch.setattr(spelling, "HELD", 10)
    assert {tuple(r) for r in spelling.word_counts(docs).collect()} == whole


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(spelling.spelling_groups(odd)) == plain(rows)
    assert spelling.spelling_groups(empty).count() == 0


def test_very_long_words(spark):
    long = "ab" * 20_000
    rows = [(1, " ".join([long] * 5)), (2, " ".join([long[:-1]] * 25)), (3, "x" * 3_000_000 + " " + "straße " * 6)]
    got = found(spelling.spelling_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == {(long, long[:-1], long[:-1], 5, 1, 25), (long[:-1], None, long[:-1], 25, 1, None), ("straße", None, "straße", 6, 0, None)}
