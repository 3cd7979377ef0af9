"""Fits draw from distinct texts and pages, whatever the number of copies."""

import random

from pyspark.sql import functions as F

from loomframe.llm import html_extract as H
from loomframe.llm.language import fit_languages, language_of


def test_rare_texts_of_a_language_of_copies_are_learned(spark):
    draw = random.Random(3)
    say = lambda letters: " ".join("".join(draw.choice(letters) for _ in range(5)) for _ in range(30))
    many = [(say("aeioulmnr"), "xx") for _ in range(60)]
    few = [(say("qwzkvpt"), "yy") for _ in range(30)]
    docs = spark.createDataFrame([*many, *few], "text string, lang string")
    copies = spark.range(40_000).select(F.lit(few[0][0]).alias("text"), F.lit("yy").alias("lang"))
    model = fit_languages(docs.unionByName(copies), sample=20)
    asked = spark.createDataFrame([(say("qwzkvpt"), "yy") for _ in range(20)] + [(say("aeioulmnr"), "xx") for _ in range(20)], "text string, lang string")
    assert asked.filter(language_of(model, F.col("text"))["lang_pred"] != F.col("lang")).count() == 0


def test_pages_of_copies_give_a_sample(spark):
    pages = spark.createDataFrame([(f"<article><p>Text {i} of a page, with words.</p></article>",) for i in range(7)], "html string")
    copies = spark.range(60_000).select(F.lit("<article><p>The same, again and again.</p></article>").alias("html"))
    assert len(H.fit_extractor(pages.unionByName(copies), sample=5).feature) == H.TREES
