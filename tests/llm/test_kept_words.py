"""The pipeline's token stage keeps fewer words in its workers than the operator's default, with the same files."""

import corpus_pipeline
from loomframe.llm import token_files


def test_the_stage_bounds_its_workers_words(spark, monkeypatch):
    made, write = [], token_files.write_token_files
    monkeypatch.setattr(corpus_pipeline, "write_token_files", lambda *a, **k: made.append(k) or write(*a, **k))
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    rows = corpus_pipeline.write_tokens(spark, docs, "").orderBy("doc_id").collect()
    assert made == [{"kept_words": corpus_pipeline.KEPT_WORDS}] and corpus_pipeline.KEPT_WORDS < token_files.KEPT_WORDS
    assert [r["start"] for r in rows] == [0, rows[0]["n_tokens"]] and rows[1]["n_tokens"] == 1
