"""A small tolerant reader of HTML: block elements and text blocks as nodes of a tree, and the nodes' features."""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)>""", re.DOTALL)
NAME = re.compile(r"</?[a-zA-Z][a-zA-Z0-9:-]*+")
MARKS = re.compile(r"[>\"']")
# Content that is never text of the page (annotations are a formula's source, which browsers do not show).
RAW = frozenset("script style noscript template textarea title iframe svg annotation annotation-xml object canvas audio video".split())
# Those that hide the rest of the page if nothing closes them; the others are passed over.
HIDES_REST = frozenset("script style noscript template textarea title iframe".split())
# Numbers of characters: leading zeros say nothing, eight digits are beyond every character.
ZEROS = re.compile(r"&#(x?)0++(?=[0-9a-f])", re.IGNORECASE)
BEYOND = re.compile(r"&#(?:[0-9]{8,}+|x[0-9a-f]{8,}+);?", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html label legend li main menu nav ol optgroup option p pre section select
summary table tbody td tfoot th thead tr ul""".split())
# A start tag closes open elements of the same group, up to the element that bounds the group.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
INLINE_IN_P = frozenset({"button", "label", "select", "option", "optgroup", "legend"})


class Tags:
    """Tags of a page by place, in time linear in its length whatever it holds.

    `TAG` decides. Once a tag was found that nothing ends, the places where tags end are worked out for the whole page
    from the back: an end is the first `>` outside quotes, and a quote that nothing closes is an ordinary character.
    """

    def __init__(self, source: str):
        self.source, self.last = source, source.rfind(">")
        self._places: list[int] | None = None
        self._ends: list[int] = []

    def match(self, at: int):
        """The tag that starts here, or None."""
        if self._places is not None and not self._ended(at):
            return None
        if at > self.last and not self.source.startswith("<!--", at):
            return None
        found = TAG.match(self.source, at)
        if found is None and self._places is None and NAME.match(self.source, at):
            self._work_out()
        return found

    def _ended(self, at: int) -> bool:
        name = NAME.match(self.source, at)
        if name is None:
            return True  # no tag of this kind, TAG says at once
        k = bisect_left(self._places, name.end())
        return k < len(self._places) and self._ends[k] >= 0

    def _work_out(self):
        self._places = [m.start() for m in MARKS.finditer(self.source)]
        self._ends = [-1] * (len(self._places) + 1)  # by mark: where a tag ends that reads it outside quotes
        following = {}
        for k in range(len(self._places) - 1, -1, -1):
            mark = self.source[self._places[k]]
            if mark == ">":
                self._ends[k] = self._places[k]
            else:
                self._ends[k] = self._ends[following.get(mark, k) + 1]
                following[mark] = k


def unescaped(text: str) -> str:
    """Character references decoded; numbers of any length, beyond the characters the replacement character."""
    if "&#" in text:
        text = BEYOND.sub("\ufffd", ZEROS.sub(r"&#\1", text))
    return entities.unescape(text)


class Page:
    """Nodes in page order: node 0 is the root, a parent comes before its children, `#text` nodes are text blocks."""

    def __init__(self, source: str):
        self.tags, self.parents, self.attrs, self.texts, self.links = ["#root"], [-1], [""], [""], [0]
        self._stack, self._open, self._chars, self._link, self._linked, self._anchors = [0], {}, [], False, 0, 0
        self._read(source)

    def _node(self, tag, attrs="", text="", linked=0):
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.attrs.append(attrs)
        self.texts.append(text)
        self.links.append(linked)

    def _flush(self):
        if self._chars:
            text = " ".join(unescaped("".join(self._chars)).split())
            if text:
                self._node("#text", text=text, linked=min(len(text), self._linked))
            self._chars, self._linked = [], 0

    def _pop(self):
        self._open[self.tags[self._stack.pop()]].pop()

    def _close_group(self, names, bounds):
        """Close the nearest open element of these names, if no bound lies above it."""
        nearest = max((self._open[n][-1] for n in names if self._open.get(n)), default=0)
        if nearest > max((self._open[n][-1] for n in bounds if self._open.get(n)), default=0):
            while len(self._stack) > nearest:
                self._pop()

    def _read(self, source):
        at, look, size, tags, unclosed = 0, 0, len(source), Tags(source), set()
        while at < size:
            start = source.find("<", look)
            if start < 0:
                self._text(source[at:])
                break
            m = tags.match(start)
            if m is None:
                look = start + 1
                continue
            if start > at:
                self._text(source[at:start])
            at = look = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
            elif tag in RAW:
                if not m[3].endswith("/") and tag not in unclosed:
                    close = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(source, at, tags.last + 1)
                    if close:
                        at = look = close.end()
                    elif tag in HIDES_REST:
                        break
                    else:
                        unclosed.add(tag)
            elif tag == "a":
                self._link = True
            elif tag == "br":
                self._chars.append(" ")
            elif tag == "hr":
                self._flush()
            elif tag in BLOCK or "-" in tag:
                self._start(tag, m[3])
            elif tag == "input":
                self._flush()
                self._node("input")
        self._flush()

    def _text(self, text):
        self._chars.append(text)
        if self._link:
            self._linked += len(text.strip())

    def _start(self, tag, attrs):
        self._flush()
        self._link = False
        if self.tags[self._stack[-1]] == "p" and tag not in INLINE_IN_P:
            self._pop()
        if tag in CLOSES:
            self._close_group(*CLOSES[tag])
        self._node(tag, attrs)
        self._open.setdefault(tag, []).append(len(self._stack))
        self._stack.append(len(self.tags) - 1)

    def _end(self, tag):
        if tag == "a":
            self._link = False
        elif self._open.get(tag):
            self._flush()
            while True:
                last = self.tags[self._stack[-1]]
                self._pop()
                if last == tag:
                    break


# Words in class, id, role and the like, in groups of a meaning each.
MEANINGS = [w.split() for w in (
    "ad ads adv advert adverts advertisement advertising sponsor sponsored dfp adsense", "nav navigation navbar navigate", "menu menubar dropdown",
    "sidebar side aside rail", "footer foot bottom contentinfo copyright", "header head masthead top topbar", "comment comments disqus reply replies respond discussion feedback",
    "cookie cookies consent gdpr notice notices alert warning disclaimer", "share sharing social follow twitter facebook", "related recommend recommended recommendations more also popular trending",
    "subscribe subscription newsletter signup", "login signin register account", "breadcrumb breadcrumbs crumbs", "pagination pager paging prev next", "tag tags category categories meta",
    "popup modal overlay dialog lightbox", "widget widgets module", "promo promotion banner offer deal teaser", "search searchbox", "hidden none invisible", "form input field contact poll survey",
    "content contents", "article articles", "post posts", "entry", "story", "main", "body text copy prose", "author byline", "caption figure gallery", "skip toolbar controls buttons button")]
MEANING = {w: i for i, ws in enumerate(MEANINGS) for w in ws}
HIDDEN = MEANING["hidden"]
NAMED = re.compile(r"""\b(?:class|id|role|itemprop|aria-label|data-component)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden|(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
CAMEL = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


def meanings(attrs: str) -> frozenset[int]:
    """Groups of the words in an element's attributes; long ones are read but not remembered."""
    return _remembered(attrs) if len(attrs) <= 4000 else _meanings(attrs)


def _meanings(attrs: str) -> frozenset[int]:
    if not attrs:
        return frozenset()
    found = {MEANING[w.lower()] for v in NAMED.findall(attrs) for w in CAMEL.findall(v) if w.lower() in MEANING}
    if SHOWN.search(attrs):
        found.add(HIDDEN)
    return frozenset(found)


_remembered = lru_cache(maxsize=20_000)(_meanings)


KINDS = ["#text", "p", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "li", "table", "td", "th", "tr", "h1", "h2", "h3",
         "blockquote", "pre", "figure", "figcaption", "button", "label", "select", "option", "fieldset", "address", "dl", "dd", "dt", "body", "input"]
KIND = {k: i for i, k in enumerate(KINDS)}
WITHIN = ["nav", "header", "footer", "aside", "form", "article", "main", "ul", "table"]
NUMBERS = 20
SELF, ABOVE = NUMBERS + len(KINDS) + 1 + len(WITHIN), NUMBERS + len(KINDS) + 1 + len(WITHIN) + len(MEANINGS)
WIDTH = ABOVE + len(MEANINGS)


def features(page: Page) -> Iterator[tuple[list[float], set[int]]]:
    """For every node but the root: its numbers, and the positions of its yes/no features."""
    tags, parents, n = page.tags, page.parents, len(page.tags)
    chars, linked, below, blocks, marks, paras, items, inputs, first = ([0] * n for _ in range(9))
    kids: list[list[int]] = [[] for _ in range(n)]
    number = 0
    for i in range(n):
        if tags[i] == "#text":
            t = page.texts[i]
            chars[i], linked[i], blocks[i] = len(t), page.links[i], 1
            marks[i] = t.count(".") + t.count(",")
            number += 1
        first[i] = number
        paras[i], items[i], inputs[i] = tags[i] == "p", tags[i] == "li", tags[i] in ("input", "button", "select", "label")
        if i:
            kids[parents[i]].append(i)
    for i in range(n - 1, 0, -1):
        p = parents[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        below[p] += below[i] + 1
        blocks[p] += blocks[i]
        marks[p] += marks[i]
        paras[p] += paras[i]
        items[p] += items[i]
        inputs[p] += inputs[i]
    depth, above, within = [0] * n, [frozenset()] * n, [frozenset()] * n
    log, whole, total = math.log1p, max(1, chars[0]), max(1, number)
    place = [0] * n
    longest = [0] * n
    alike: list[Counter] = [Counter()] * n  # the children's tags
    for i in range(n):
        if kids[i]:
            alike[i] = Counter(tags[c] for c in kids[i])
        for k, c in enumerate(kids[i]):
            place[c] = k
        longest[i] = max([chars[c] for c in kids[i]], default=0)
    for i in range(1, n):
        p = parents[i]
        depth[i] = depth[p] + 1
        own = meanings(page.attrs[i])
        above[i] = above[p] | own
        within[i] = within[p] | {tags[i]} if tags[i] in WITHIN else within[p]
        c, b, siblings = chars[i], max(1, blocks[i]), len(kids[p])
        numbers = [log(c), linked[i] / max(1, c), log(c / (below[i] + 1)), log(c / b), c / whole, depth[i], log(siblings), place[i] / siblings,
                   c / max(1, longest[p]), alike[p][tags[i]] / siblings, first[i] / total, marks[i] / max(1, c), items[i] / b,
                   paras[i] / b, inputs[i], c / max(1, chars[p]), linked[p] / max(1, chars[p]), log(chars[p]), paras[p] / max(1, blocks[p]), log(below[i])]
        yes = {NUMBERS + KIND.get(tags[i], len(KINDS))}
        yes.update(NUMBERS + len(KINDS) + 1 + WITHIN.index(t) for t in within[i])
        yes.update(SELF + m for m in own)
        yes.update(ABOVE + m for m in above[p])
        yield numbers, yes
