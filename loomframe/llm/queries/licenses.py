"""Licenses named in all documents."""

from pyspark.sql import functions as F

from loomframe.llm.licenses import CONFIDENCE, label_list, scan_licenses
from loomframe.llm.registry import query, table


@query("op8_license_scan")
def op8(spark, sf):
    found = scan_licenses(table(spark, sf, "documents"))
    sure = F.transform("detections", lambda d: F.element_at(F.create_map(*[F.lit(x) for kv in CONFIDENCE.items() for x in kv]), d["priority"]))
    base = F.when(F.size("base") > 0, F.lit(CONFIDENCE[3])).otherwise(F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"), label_list(F.col("base.label")).alias("base_labels"),
        label_list(F.concat("base.label", "detections.label")).alias("labels"),
        F.greatest(base, F.coalesce(F.array_max(sure), F.lit(0.0))).alias("score"))
