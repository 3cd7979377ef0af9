"""The mix of all documents by source."""

from loomframe.llm.mixing import mix
from loomframe.llm.registry import query, table

WEIGHTS, SHARE, MOST = [3.0, 1.0, 2.0], 1.5, 2.0


@query("op2_source_mix")
def op2(spark, sf):
    out = mix(table(spark, sf, "documents"), WEIGHTS, SHARE, MOST)
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "quality", "copies")
