"""The pipeline's stages and the registered queries."""

import corpus_pipeline
from loomframe.llm.catalog import all_oracles, all_queries


def test_names():
    numbers = sorted(int(n[2:].split("_")[0]) for n in all_queries())
    assert numbers == list(range(1, 14)) and set(all_oracles()) <= set(all_queries())
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_on_odd_rows(spark, stored, sf, tmp_path):
    extra = stored.select("doc_id", "text", "lang", "source", stored["size"].alias("n_chars"))
    base = spark.read.parquet(f"{sf}/documents.parquet")
    docs, sizes = base.unionByName(extra.withColumn("doc_id", extra["doc_id"] + 10_000)), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        sizes.append(docs.count())
        docs = stage(spark, docs, sf)
        assert docs.columns == (base.columns if i < 4 else ["doc_id", "start", "n_tokens", "ids_crc32"])
    rows = docs.orderBy("start").collect()
    assert sizes[1] == sizes[0] - 5 and sizes[2] < sizes[1] and len(rows) == sizes[4]
    assert [r["start"] for r in rows] == [sum(r["n_tokens"] for r in rows[:i]) for i in range(len(rows))]


def test_leaks_query_matches_sql(spark, sf):
    from check_queries import compare, connect
    text, fine, _ = compare(spark, connect(sf), "op1_benchmark_decontamination", sf)
    assert fine, text
