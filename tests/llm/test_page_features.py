"""Features do not depend on a page's size, and formulas are text."""

from loomframe.llm.dom import Page, features, meanings


def test_pages_of_any_length_have_the_same_features():
    for n in (5, 60):
        page = Page("<section><div>Buy</div>" + "<p>Text.</p>" * n + "</section>")
        share = {page.tags[i]: f[0][9] for i, f in enumerate(features(page), 1)}
        assert share["div"] == 1 / (n + 1) and share["p"] == n / (n + 1)
    long = 'style="background: url(data:image/png;base64,' + "A" * 5000 + ')" class="advert"'
    assert meanings(long) == meanings('class="advert"') != frozenset()


def test_formulas_are_text():
    page = Page("<p>Let <math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='tex'>x=2</annotation></semantics></math> hold.</p>")
    assert [t for t in page.texts if t] == ["Let x=2 hold."]
