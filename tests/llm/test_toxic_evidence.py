"""Learned toxic entries: evidence in distinct neighbourhoods decides, not numbers of copies."""

import random

from loomframe.llm.toxicity import fit_toxicity


def test_copies_of_a_clean_text_do_not_hide_an_entry(spark):
    draw = random.Random(4)
    plain = lambda: [draw.choice(["alpha", "beta", "gamma", "delta"]) + draw.choice("uvwxyz") for _ in range(40)]
    docs = [(i, " ".join(plain())) for i in range(100)]
    toxic = [plain() for _ in range(50)]
    for w in toxic:
        w[draw.randrange(40)] = "grobnik"
    docs += [(100 + i, " ".join(w)) for i, w in enumerate(toxic)]
    once = " ".join([*plain(), "grobnik"])
    docs += [(1000 + i, once) for i in range(300)]
    marks = [(i, int(100 <= i < 1000)) for i, _ in docs]
    lexicon = fit_toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert any(e.startswith(" grob") for e in lexicon.entries)


def test_copies_of_a_long_toxic_text_do_not_crowd_entries_out(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("bcdfgklmnprst") + draw.choice("aeiou") for _ in range(5))
    plain = [word() for _ in range(40)]
    docs = [(i, " ".join(draw.choice(plain) for _ in range(40)), 0) for i in range(100)]
    docs += [(200 + i, " ".join([*(draw.choice(plain) for _ in range(20)), "zuzuzuzu", *(draw.choice(plain) for _ in range(20))]), 1) for i in range(50)]
    long = " ".join(word() for _ in range(6000))  # up to five forms of each word
    docs += [(1000 + i, long, 1) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    lexicon = fit_toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert any(e.startswith(" zuzu") for e in lexicon.entries)
