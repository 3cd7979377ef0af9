"""Secrets in all documents, plain and encoded."""

from pyspark.sql import functions as F

from loomframe.llm.registry import query, table
from loomframe.llm.secret_scan import KINDS, scan_secrets, span_list


@query("op12_secret_scan")
def op12(spark, sf):
    found = scan_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["via"] == "")
    counts = [F.size(F.filter(base.getField("kind"), lambda k: k == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))
