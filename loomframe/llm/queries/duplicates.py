"""Near-duplicate groups of all documents."""

from loomframe.llm.registry import query, table
from loomframe.llm.simhash_dedup import near_duplicates


@query("op5_simhash_near_dedup")
def op5(spark, sf):
    return near_duplicates(table(spark, sf, "documents"))
