"""Pages made to cost time: reading stays linear and equal to a plain reader."""

import random
import time

import pytest

from loomframe.llm import dom
from loomframe.llm import html_extract as H
from loomframe.llm.dom import Page, unescaped

PIECES = ["<", ">", '"', "'", "a ", "p", "div ", "/", "!", "--", " ", "x", "</p>", "<li>", "<ul>", "</ul>", "<script>", "</script", "<title>", "&#65;"]


class Searched:
    """Tags by trying the expression at every place, without memory."""

    def __init__(self, source):
        self.source, self.last = source, source.rfind(">")

    def match(self, at):
        return dom.TAG.match(self.source, at)


def test_reading_equals_a_search_at_every_place(monkeypatch):
    draw = random.Random(5)
    sources = ["".join(draw.choice(PIECES) for _ in range(draw.randint(1, 40))) for _ in range(20_000)]
    fast = [vars(Page(s)) for s in sources]
    monkeypatch.setattr(dom, "Tags", Searched)
    assert [vars(Page(s)) for s in sources] == fast


@pytest.mark.parametrize("source", ['<a "' * 250_000, "</p " * 250_000, '<a "<b>" ' * 100_000, "<" + "a" * 1_000_000, "<!" * 500_000,
                                    "<script>" + "</script " * 110_000, "<svg>" * 200_000,
                                    "<li><ul>" + "<div>" * 80_000 + "<li></li>" * 80_000], ids=lambda s: s[:12])
def test_a_million_characters_take_seconds(source):
    begin = time.process_time()
    Page(source)
    assert time.process_time() - begin < 5


def test_unclosed_media_hide_nothing_and_unclosed_scripts_hide_the_rest():
    for tag in ("video", "audio", "canvas", "object", "svg"):
        assert [t for t in Page(f"<article><{tag}>no</article><p>after</p>").texts if t] == ["no", "after"]
        assert [t for t in Page(f"<p>a</p><{tag}>no</{tag}><p>b</p>").texts if t] == ["a", "b"]
    assert [t for t in Page("<p>a</p><script>no<p>no</p>").texts if t] == ["a"]


def test_line_breaks_are_white_space_of_their_block():
    assert [t for t in Page("<p>a<br>b<br/> c</p><p>d</p>").texts if t] == ["a b c", "d"]


def test_numbers_of_characters_may_have_any_length():
    assert unescaped("&#" + "0" * 9000 + "65;&#x00041;&#" + "9" * 9000 + ";&#0;&amp;") == "AA��&"


def test_blocks_of_nodes_do_not_change_texts(monkeypatch):
    sources = [f"<article>{'<p>One sentence, and more words to it.</p>' * n}</article><nav><a>Menu</a></nav>" for n in (1, 40, 3)] + [None, ""]
    model = H.BoostedTrees(*[__import__("numpy").zeros(s) for s in ((0, 0), (0, 0), (0, 1))], 1.0)
    whole = H.extract(model, sources)
    monkeypatch.setattr(H, "NODES", 7)
    assert H.extract(model, sources) == whole and whole[1].count("\n") == 40 and whole[3:] == ["", ""]
