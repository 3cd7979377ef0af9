"""A training-data pipeline over `documents`: language, near-duplicates, benchmark leaks, source mix, token files.

Each stage takes what its predecessor kept; all but the last return the columns of `documents`, which is written as Parquet
between stages. Fingerprints, language scores and token ids have no SQL form, so the whole has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomframe.llm.common import columns, fresh, shared_folder, written
from loomframe.llm.decontaminate import without_contaminated
from loomframe.llm.language import UNKNOWN, fit_languages, language_of
from loomframe.llm.mixing import mixed_documents
from loomframe.llm.near_copies import keep_one_near_copy
from loomframe.llm.token_files import default_tokenizer, read_documents, write_token_files

# A language with less than so many times the probability of a guess among all languages is not told (0.3 of four).
LEAST_LIFT = 1.2
WEIGHTS, SHARE, MOST = [3.0, 1.0, 2.0], 1.5, 2.0
# Rows and bytes of texts that go to a Python worker at once: workers of several stages stay beside the executor's heap.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
# Encoded words that a Python worker keeps: between runs they stay in idle workers, beside all other stages.
KEPT_WORDS = 100_000


def bound_batches(spark: SparkSession) -> None:
    """Whole texts are large rows; the session's default batch of 10,000 of them is not."""
    for setting, value in BATCHES.items():
        spark.conf.set(setting, value)


def least_score(languages: int) -> float:
    """The least probability at which one of so many languages counts as told; of one language it always is."""
    return min(1.0, LEAST_LIFT / max(1, languages))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language that is told with enough probability; those without a letter go."""
    bound_batches(spark)
    (found,) = fresh(docs, "_language")
    model = fit_languages(docs)
    told = docs.withColumn(found, language_of(model, F.col("text")))
    return told.filter((F.col(found)["lang_pred"] != UNKNOWN) & (F.col(found)["score"] >= least_score(len(model.languages)))).select(*columns(docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: those that op5 links, and those of a similarity of at least 0.8 (five-word shingles)."""
    bound_batches(spark)
    return keep_one_near_copy(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage nearly equal to an item of the benchmark."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs, WEIGHTS, SHARE, MOST)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: a row per document and copy with its place, length and checksum."""
    bound_batches(spark)
    folder = shared_folder(spark)
    write_token_files(docs, folder, default_tokenizer(), kept_words=KEPT_WORDS)
    return read_documents(spark, folder)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("source_mix", mix_sources),
    ("token_files", write_tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
