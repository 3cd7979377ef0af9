"""Spelling variants among the words of all documents."""

from loomframe.llm.registry import query, table
from loomframe.llm.spelling import spelling_groups


@query("op11_spelling_variants")
def op11(spark, sf):
    return spelling_groups(table(spark, sf, "documents").select("doc_id", "text"))
