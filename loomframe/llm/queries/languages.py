"""The language of all documents, learned from those whose hash lets them."""

from pyspark.sql import functions as F

from loomframe.llm.common import crc_bucket
from loomframe.llm.language import fit_languages, language_of
from loomframe.llm.registry import query, table


@query("op3_language_id")
def op3(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = crc_bucket("doc_id", 4) == 2
    model = fit_languages(docs.filter(~held_out))
    out = docs.select("doc_id", held_out.alias("held_out"), language_of(model, F.col("text")).alias("found"))
    return out.select("doc_id", "held_out", "found.lang_pred", "found.score")
