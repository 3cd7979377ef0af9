import os

import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Rows that every operator on texts must take: nulls in all columns, empty and odd texts, ties and repeated rows.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "b"),
    (3, None, "en", "a"),
    (4, "", "fr", None),
    (None, "kein Text ohne Nummer", "de", "b"),
    (None, None, None, None),
    (5, " \t\n ", "es", "c"),
    (6, "12 + 34 = 46 !!", None, "c"),
    (7, "word " * 30_000 + "end", "en", "a"),
    (8, "é à ü ß 中文 \U0001f600 İ", "fr", "é"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns whose names clash with those that operators use inside."""
    df = spark.createDataFrame(ODD, SCHEMA)
    for name in ("size", "words", "fingerprint", "key", "place", "score", "_text", "slice", "target", "h", "component"):
        df = df.withColumn(name, df["doc_id"] * 0 + 99)
    return df


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def stored(spark, odd, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    odd.write.parquet(folder)
    return spark.read.parquet(folder)
