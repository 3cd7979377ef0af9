"""The toxicity of all documents, learned from labelled ones whose hash lets them."""

from pyspark.sql import functions as F

from loomframe.llm.common import crc_bucket
from loomframe.llm.registry import query, table
from loomframe.llm.toxicity import fit_toxicity, toxicity_of

THRESHOLD = 0.7


@query("op9_toxicity")
def op9(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = crc_bucket("doc_id", 3) == 1
    lexicon = fit_toxicity(docs.filter(~held_out), table(spark, sf, "labels").filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity_of(lexicon, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
