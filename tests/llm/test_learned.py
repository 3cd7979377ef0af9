"""Language, toxicity and page models: held-out accuracy and odd rows."""

import random

import numpy as np
from pyspark.sql import functions as F

from loomframe.llm import html_extract as H
from loomframe.llm.codepoints import fold
from loomframe.llm.dom import Page
from loomframe.llm.language import fit_languages, fit_temperature, language_of, ngram_counts
from loomframe.llm.queries.languages import op3
from loomframe.llm.queries.toxic import op9
from loomframe.llm.toxicity import ToxicLexicon, fit_toxicity, toxicity_of, with_seeds


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op3(spark, sf).join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_rows(spark, odd, empty, sf):
    model = fit_languages(spark.read.parquet(f"{sf}/documents.parquet"))
    got = {r["doc_id"]: r["p"] for r in odd.select("doc_id", language_of(model, F.col("text")).alias("p")).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (3, 4, 5, 6))
    assert empty.select(language_of(model, F.col("text"))).count() == 0
    assert fit_languages(empty).languages == []


def test_ngrams_do_not_depend_on_pieces(monkeypatch):
    import loomframe.llm.language as L
    text = "Ab  c--d é\n" * 50
    whole = ngram_counts(text)
    monkeypatch.setattr(L, "pieces", lambda t, size=7: (t[i:i + 7] for i in range(0, len(t), 7)))
    assert (ngram_counts(text) == whole).all() and ngram_counts("12 !") is None and ngram_counts(None) is None


def test_temperature_is_that_of_the_scores():
    draw = np.random.default_rng(2)
    z = draw.normal(size=(4000, 3)) * 2
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    y = np.array([draw.choice(3, p=r) for r in p])
    assert abs(fit_temperature(z * 5, y) - 5) < 0.8


def test_folding():
    assert fold("  L0S3R​!! Ｓｔúpid, пате").startswith(" ioser stupid ")
    assert fold("L0S3R") == " ioser "
    assert fold("tr4sh Тrаsh") == " trash trash " and fold("") == " "


def test_toxicity_learned_and_seeded(spark, sf, odd, empty):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = op9(spark, sf).join(labels, "doc_id", "left").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert sum(r["predicted"] == r["toxic"] for r in rows if r["toxic"] is not None) >= 0.95 * sum(r["toxic"] is not None for r in rows)
    lexicon = fit_toxicity(empty, labels)
    assert lexicon.entries == with_seeds()
    assert odd.select(toxicity_of(lexicon, F.col("text")).alias("s")).filter("s > 0.5").count() == 0


def test_new_words_are_learned_and_copies_count_once(spark):
    draw = random.Random(1)
    plain = lambda: " ".join(draw.choice(["alpha", "beta", "gamma", "delta", "eps"]) + draw.choice("xyz") for _ in range(60)).split()
    docs, marks = [], []
    for i in range(120):
        w = plain()
        if i % 3 == 0:
            for _ in range(3):
                w.insert(draw.randrange(60), "grobnik" + draw.choice(["", "a", "en"]))
        docs.append((i, " ".join(w)))
        marks.append((i, int(i % 3 == 0)))
    copied = " ".join([*plain(), "innocent"])  # one toxic text with a harmless word, copied often
    docs += [(1000 + i, copied) for i in range(200)]
    marks += [(1000 + i, 1) for i in range(200)] + [(5, None)]
    lexicon = fit_toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert any(e.startswith(" grob") for e in lexicon.entries) and not any(e.startswith(" inno") for e in lexicon.entries)
    assert lexicon.strength("Gr0bnik" + " word" * 20) > lexicon.strength("word " * 20) == 0


def test_exceptions_spare_words():
    lexicon = ToxicLexicon(with_seeds())
    assert lexicon.strength("put it in the trash can") == 0 < lexicon.strength("you are tr4sh")


HAND = """<html><head><title>x</title><script>var a="<p>no</p>";</script></head><body><div class="topbar"><a href=/>Home</a></div>
<div id=left><ul><li><a href=x>One</a><li><a>Two</a></ul></div><div class="article-body"><h1>My title</h1><p>First paragraph of the
 text,&nbsp;with many words &amp; things to say.<p>Second one, which <b>goes</b> on for a while.<div class="ad-slot">Buy now!</div><p>Third.</div>
<div class="comments"><p>Great post, I liked it a lot, thank you.</p></div><form><input name=q><button>Go</button></form><footer>Legal</footer>"""


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    model = H.fit_extractor(pages)
    assert H.extract(model, [HAND])[0] == ("My title\nFirst paragraph of the text, with many words & things to say.\nSecond one, which goes on for a while.\nThird.")
    assert H.extract(model, ["", None, "<", "<p", "<!-- x", "<script>a", "</p></div>", "<div>" * 3000]) == [""] * 2 + H.extract(model, ["<", "<p"]) + [""] * 4
    sources = [r["html"] for r in pages.collect()]
    got = H.extract(model, sources)
    import html
    import re
    for s, g in zip(sources, got):
        parts = re.split(r"</?(?:p|h1|br)>", re.search(r"<article>(.*)</article>", s, re.DOTALL)[1].replace("<b>", "").replace("</b>", ""))
        assert g == "\n".join(" ".join(html.unescape(p).split()) for p in parts if p.strip())
    draw, exact = random.Random(99), 0
    for s in sources:
        inner = H.ROOT.search(s)[3]
        page = Page(H.rebuilt(inner, [x for x in re.split(r"(?<=[.!?])\s+|<[^>]*>", inner) if x.strip()], draw))
        want = [i for i, y in enumerate(H.labels(page), 1) if y and page.tags[i] == "#text"]
        exact += H.decode(page, model.decision(H.matrix([page]))) == want
    assert exact >= 0.9 * len(sources)


def test_decoding_is_the_best_consistent_choice():
    draw = np.random.default_rng(8)
    for _ in range(50):
        page = Page("<div><p>a</p><section><p>b</p>c</section></div><ul><li>d</ul>")
        n = len(page.tags)
        odds = draw.normal(size=n - 1)
        best = max((sum(odds[i - 1] for i in range(1, n) if m >> i & 1), m) for m in range(0, 1 << n, 2)
                   if all(not m >> i & 1 or page.parents[i] == 0 or m >> page.parents[i] & 1 for i in range(1, n)))
        assert H.decode(page, odds) == [i for i in range(1, n) if best[1] >> i & 1 and page.tags[i] == "#text"]


def test_pages_without_rows(spark):
    pages = spark.createDataFrame([(1, None), (2, "<p>hello there</p>"), (2, "<p>hello there</p>")], "page_id long, html string")
    model = H.fit_extractor(pages.filter("false"))
    assert [r["t"] for r in pages.orderBy("page_id").select(H.main_text(model, F.col("html")).alias("t")).collect()] == ["", "hello there", "hello there"]
