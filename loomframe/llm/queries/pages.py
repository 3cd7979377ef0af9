"""The main text of all pages."""

from pyspark.sql import functions as F

from loomframe.llm.html_extract import fit_extractor, main_text
from loomframe.llm.registry import query, table


@query("op4_html_main_text")
def op4(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    model = fit_extractor(pages)
    out = pages.select("page_id", "url", main_text(model, F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
