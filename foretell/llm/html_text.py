"""Main text of web pages: the maximum-scoring run of words and tags.

A page becomes a sequence of blocks (the text between two block-level tags) with the tags
before each.  A word scores by what surrounds its block: the enclosing elements, words of
their class and id, the share of links and the length of the block; a tag costs.  One linear
scan finds the contiguous run of greatest sum, and the blocks of that run that stand in an
element named as boilerplate are left out.  Only a whole name (or one made of such names
alone, as ``cookie-banner``) drops; a part of a name (``right-sidebar``) is a feature of the
score.  No element drops its text, or is scored by such names, if it is ``html`` or ``body``,
holds the ``article`` or ``main`` with most words, or, on pages where none of these stands
outside boilerplate, holds most words that are no links (``nav``, ``aside``, ``footer``,
``menu`` and ``dialog`` stay boilerplate there).  A ``header`` in an ``article`` or ``main`` holds its
headline and is scored like other text.

The weights come from labelled pages: those with an ``article`` or ``main`` element, whose
content is what stands in it outside such boilerplate.  Each is seen once as it is and once
with these two elements hidden, so that pages without them are scored by the rest.  They are
log-odds fitted by Newton's method with a ridge; names in ``BOILERPLATE`` and ``CONTENT``
start from a prior and need not occur in the sample (about ``SAMPLE`` pages, by a hash).

Defined results: a null or empty page, or one where no run scores above 0, gives an empty
text; an unclosed tag, comment or ``RAW`` element runs to the end of the page; of equal runs
the first wins.  Text in ``svg``, ``template`` and the options of a choice is dropped, that in
``math``, ``object``, ``canvas`` and ``button`` is text like all else.  Self-closed elements are
empty, and end tags are optional where HTML has them so.  Repeated rows are extracted each; an
empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pandas as pd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import mapped, stored

# fixed values: elements and name parts by their use
RAW = frozenset("script style noscript iframe title textarea".split())  # run to their own end tag, whatever stands in them, and are dropped
DROPPED = frozenset("svg template select option optgroup".split())  # elements like others, without text
# start tags that end an open svg, as in the HTML standard, and further blocks
BREAKS = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li listing main article section menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var aside header footer nav figure form".split())
INTEGRATION = frozenset("foreignobject desc title".split())  # elements of svg in which start tags end nothing
CHOICES = frozenset("select option optgroup".split())  # ended by a start tag of a block
BOILERPLATE_TAGS = frozenset("nav aside footer header form menu dialog fieldset".split())
NO_WRAPPERS = BOILERPLATE_TAGS - {"form", "header", "fieldset"}  # hold no page, however short the rest of it is
MAIN_TAGS = frozenset(("article", "main"))
BOILERPLATE = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer form gdpr header hidden login masthead menu modal nav navbar navigation newsletter notice notices notification "
    "alert pager pagination paywall popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup "
    "skip social sponsor sponsored subscribe tags toolbar topbar widget widgets".split())
CONTENT = frozenset("article articlebody body content entry main maincontent post story text".split())
MATH = frozenset(
    "math maction annotation annotation-xml menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
    "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
SPACED = frozenset("br button canvas datalist object param mtd mtr".split())  # white space within their block; what they hold is text like all else
INLINE = MATH | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub "
    "sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# open elements that a start tag ends
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)|(?P<text>[^<]+|<)", re.S | re.I)
SPECIAL = re.compile("[\"'>]")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
NAMED = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
PART = re.compile(r"[a-z]+")
MODIFIERS = frozenset("has no not with without is overflow".split())  # a name that begins so says nothing of its content
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

SAMPLE = 2_000
TAGS = 300
FEATURES = ("bias", "main", "boilerplate", "content", "list", "heading", "paragraph", "table", "links", "few links", "short", "long",
            "named")
#: where the weights start, and what they are drawn to
PRIOR = np.array([0.0, 1.5, -4.0, 1.0, -0.5, 0.5, 0.5, -0.3, -2.0, -0.5, -0.5, 0.5, -1.5])
RIDGE = np.array([0.5, 0.5, 5.0, 2.0, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 2.0])
UNKNOWN_TAG = -1.0  # score of a tag that the sample does not have
FREE_WORDS = 5  # words of a block that count against a run, so that one long aside does not cut it


def _marks(tag: str, rest: str) -> frozenset:
    """What an element says about its content: main, boilerplate, named (in part as boilerplate), content."""
    found = set()
    if tag in MAIN_TAGS:
        found.add("main")
    if tag in BOILERPLATE_TAGS:
        found.add("boilerplate")
    if "=" in rest or "hidden" in rest.lower():
        for name, a, b, c in NAMED.findall(rest):
            value = (a or b or c).lower()
            name = name.lower()
            if name == "style":
                found |= {"boilerplate"} if HIDDEN.search(value) else set()
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                found.add("boilerplate")
            else:
                split = [PART.findall(v) for v in value.split()]
                if any(p and BOILERPLATE.issuperset(p) for p in split) or name == "role" and any(
                        p in (["banner"], ["complementary"], ["contentinfo"], ["search"]) for p in split):
                    found.add("boilerplate")
                elif any(p and p[0] not in MODIFIERS and not BOILERPLATE.isdisjoint(p) for p in split):
                    found.add("named")
                elif any(not CONTENT.isdisjoint(p) for p in split):
                    found.add("content")
    return frozenset(found)


class Block:
    __slots__ = ("text", "words", "linked", "tags", "marks", "names")

    def __init__(self, text, words, linked, tags, marks, names):
        self.text, self.words, self.linked, self.tags, self.marks, self.names = text, words, linked, tags, marks, names


DROPS = frozenset(("boilerplate", "named"))


class Element:
    """An open or closed block element: its words, those of them in links, and its own as an article."""

    __slots__ = ("tag", "marks", "parent", "words", "linked", "own")

    def __init__(self, tag, marks, parent):
        self.tag, self.marks, self.parent = tag, marks, parent
        self.words = self.linked = self.own = 0


def _overrule(elements: list, words: int, linked: int) -> None:
    """Takes the names of boilerplate from what holds the main text of the page.

    ``elements`` stand before what they hold.
    """
    dropped = [False]  # by element, whether it or one around it is boilerplate
    place = {None: 0}
    longest, free = None, False
    for i, e in enumerate(elements, 1):
        if e.tag in ("html", "body"):
            e.marks -= DROPS
        place[e] = i
        dropped.append(dropped[place[e.parent]] or "boilerplate" in e.marks)
        if e.own:
            longest = e if longest is None or e.own > longest.own else longest
            free = free or not dropped[i]
    e = longest
    while e is not None:
        e.marks -= DROPS
        e = e.parent
    if not free:
        for e in elements:
            if e.tag not in NO_WRAPPERS and 2 * (e.words - e.linked) > words - linked:
                e.marks -= DROPS


class Ends:
    """Where the tags of a page end: at the first ``>`` outside quotes, or with the page.

    A quote without a second one ends no tag.  What was found from a quote or ``>`` on is remembered, so
    that each is looked at once, however many tags run into it.
    """

    def __init__(self, page: str):
        self.page, self.known = page, {}
        self.next = (0, -1)  # from the first place to the second there is nothing special but at the second

    def _special(self, at: int) -> int:
        if not self.next[0] <= at <= self.next[1]:
            m = SPECIAL.search(self.page, at)
            self.next = (at, m.start() if m else len(self.page))
        return self.next[1]

    def end(self, at: int) -> int:
        """The place of the end of a tag that goes on at ``at``; -1 if there is none."""
        page, passed = self.page, []
        at = self._special(at)
        while at not in self.known:
            passed.append(at)
            if at == len(page) or page[at] == ">":
                self.known[at] = at
                break
            close = page.find(page[at], at + 1) if self.known.get(page[at]) is None else -1
            if close < 0:
                self.known[page[at]] = self.known[at] = -1  # nor does a later one of these have a second one
                break
            at = self._special(close + 1)
        for p in passed:
            self.known[p] = self.known[at]
        return self.known[at]


class Open:
    """Open elements with their numbers by tag, so that an end tag without one costs nothing."""

    def __init__(self):
        self.tags, self.items, self.counts = [], [], Counter()

    def __bool__(self):
        return bool(self.tags)

    def __contains__(self, tag):
        return self.counts[tag] > 0

    def push(self, tag: str, item=None) -> None:
        self.tags.append(tag)
        self.items.append(item)
        self.counts[tag] += 1

    def pop(self) -> None:
        self.counts[self.tags.pop()] -= 1
        self.items.pop()

    def pop_from(self, i: int) -> None:
        while len(self.tags) > i:
            self.pop()

    def pop_through(self, tag: str) -> bool:
        """Closes the innermost element of that tag and all in it; False if there is none."""
        if tag not in self:
            return False
        while self.tags[-1] != tag:
            self.pop()
        self.pop()
        return True


def _hides(hidden: Open, tag: str, rest: str, ended: bool, stack: Open) -> bool:
    """Whether a tag stands in an element without text or begins or ends one; keeps ``hidden`` up to date.

    The item of a hidden tag is the place of the innermost one that decides what ends it.
    """
    if ended:
        if hidden.pop_through(tag):
            return True
        if tag in INLINE or tag in SPACED or tag in stack:
            hidden.pop_from(0)  # the end of an element around it
        return bool(hidden) or tag in DROPPED
    while hidden:
        i = hidden.items[-1]
        if hidden.tags[i] == "svg" and tag in BREAKS:
            hidden.pop_from(i)
        elif hidden.tags[i] in CHOICES and not (tag in DROPPED or tag in INLINE or tag in ("br", "hr")):
            hidden.pop_from(i)
        else:
            break
    if not hidden and tag not in DROPPED:
        return False
    if tag in CHOICES:  # their end tags are optional
        for other in ("option", "optgroup")[: 1 + (tag == "optgroup")]:
            if hidden and hidden.tags[-1] == other:
                hidden.pop()
    if tag not in VOID and not rest.endswith("/"):
        hidden.push(tag, len(hidden.tags) if tag in DROPPED or tag in INTEGRATION else hidden.items[-1])
    return True


def blocks(page: str) -> list:
    """The blocks of a page with text, in order."""
    out, stack, parts = [], Open(), []  # the stack holds the open block elements
    elements, inside = [], []  # all elements of the page, and of each block the innermost one around it
    tags, linked = [], 0
    in_link = False

    def close():
        nonlocal parts, tags, linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, len(text.split()), linked, tags, None, frozenset(stack.tags[-3:])))
            inside.append(stack.items[-1] if stack else None)
            tags, linked = [], 0
        parts = []

    hidden = Open()  # tags from an element without text on
    ends_at = Ends(page)
    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        text, rest = m["text"], ""
        if m["tag"] is not None:
            end = ends_at.end(m.end())
            if end < 0:
                text = "<"
            else:
                rest = page[m.end() : end]
        at = at + 1 if text == "<" else m.end() if m["tag"] is None else end + 1
        if text is not None:
            if hidden:
                continue
            parts.append(text)
            if in_link:
                linked += len(text.split())
            continue
        if m["tag"] is None:
            continue
        tag, ended = m["tag"].lower(), bool(m["end"])
        if tag in RAW:
            if not ended and not ("svg" in hidden and rest.endswith("/")):
                end = RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
                tags.append(tag)
                parts.append(" ")
            continue
        if tag == "head":  # no text stands in it but that of raw elements, and its end tag is optional
            tags.append("/head" if ended else tag)
            continue
        if (hidden or tag in DROPPED) and _hides(hidden, tag, rest, ended, stack):
            tags.append("/" + tag if ended else tag)
            parts.append(" ")
            continue
        if tag == "a":
            in_link = not ended
        if tag in SPACED:
            parts.append(" ")
            tags.append("/" + tag if ended else tag)
            continue
        if tag in INLINE:
            marks = _marks(tag, rest) if not ended and tag != "a" and rest else frozenset()
            if "boilerplate" not in marks:
                if ended and stack and stack.tags[-1] == tag:  # an inline element that was kept as a block
                    close()
                    stack.pop()
                tags.append("/" + tag if ended else tag)
                continue
        close()
        in_link = False
        tags.append("/" + tag if ended else tag)
        if ended:
            stack.pop_through(tag)
        else:
            ends = CLOSES.get(tag)
            if ends and stack and stack.tags[-1] in ends:
                stack.pop()
            if tag not in VOID and not rest.endswith("/"):
                marks = _marks("" if tag == "header" and ("article" in stack or "main" in stack) else tag, rest)
                element = Element(tag, marks, stack.items[-1] if stack else None)
                stack.push(tag, element)
                elements.append(element)
    close()
    _mark(out, inside, elements)
    return out


def _mark(out: list, inside: list, elements: list) -> None:
    """Gives the blocks the marks of the elements around them."""
    if any(not DROPS.isdisjoint(e.marks) for e in elements):
        for b, e in zip(out, inside):
            if e is not None:
                e.words, e.linked = e.words + b.words, e.linked + min(b.linked, b.words)
        owner: dict = {None: None}  # the nearest article or main around an element
        for e in elements:
            owner[e] = e if "main" in e.marks else owner[e.parent]
        for e in elements:
            if owner[e] is not None:
                owner[e].own += e.words
        for e in reversed(elements):
            if e.parent is not None:
                e.parent.words, e.parent.linked = e.parent.words + e.words, e.parent.linked + e.linked
        _overrule(elements, sum(b.words for b in out), sum(min(b.linked, b.words) for b in out))
    around: dict = {None: frozenset()}
    for e in elements:
        up = around[e.parent]
        around[e] = up if e.marks <= up else up | e.marks
    for b, e in zip(out, inside):
        b.marks = around[e]


def features(b: Block, masked: bool = False) -> tuple:
    share = b.linked / max(b.words, 1)
    return (1, "main" in b.marks and not masked, "boilerplate" in b.marks, "content" in b.marks, bool(b.names & {"li", "ul", "ol", "dl"}),
            bool(b.names & {"h1", "h2", "h3", "h4", "h5", "h6"}), "p" in b.names, bool(b.names & {"td", "th", "table"}),
            share > 0.5, 0 < share <= 0.5, b.words <= 3, b.words >= 10, "named" in b.marks)


class Weights:
    """Scores of words by the features of their block, and of tags by name."""

    def __init__(self, word=PRIOR, tags: dict | None = None):
        self.word, self.tags = np.asarray(word), tags or {}
        self.known: dict = {}

    def of(self, found: tuple) -> float:
        if found not in self.known:
            self.known[found] = float(np.clip(self.word @ np.array(found, float), -3, 3))
        return self.known[found]

    def words(self, b: Block) -> float:
        w = self.of(features(b))
        return w * (b.words if w > 0 else min(b.words, FREE_WORDS))

    def before(self, b: Block) -> float:
        return sum(self.tags.get(t, UNKNOWN_TAG) for t in b.tags)


def best_run(scores: list) -> tuple:
    """``(start, end)`` of the contiguous run with the greatest sum above 0; empty if there is none."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, span = total, (start, i + 1)
    return span


def extract(page: str, weights: Weights) -> str:
    found = blocks(page)
    scores = [s for b in found for s in (weights.before(b), weights.words(b))]
    start, end = best_run(scores)
    # tags score below 0, so a run begins and ends with words
    return "\n".join(b.text for b in found[start // 2 : (end + 1) // 2] if "boilerplate" not in b.marks)


def _counted(batches):
    """Words and tags of the blocks of labelled pages, by features and label."""
    for pdf in batches:
        words: Counter = Counter()
        for page in pdf["html"]:
            found = blocks(page)
            if not any("main" in b.marks for b in found):
                continue
            for b in found:
                content = "main" in b.marks and "boilerplate" not in b.marks
                for masked in (False, True):
                    words["".join(str(int(f)) for f in features(b, masked)), content] += min(b.words, 100)
                for tag in b.tags:
                    words["<" + tag[:20], content] += 1
        yield pd.DataFrame([(f, c, n) for (f, c), n in words.items()], columns=["features", "content", "n"])


def trained(pages: DataFrame, key: str = "page_id", page: str = "html", sample: int = SAMPLE) -> Weights:
    """Weights fitted on the labelled pages of a sample of about ``sample``.

    What comes to the driver is a row per combination of the thirteen yes-or-no features, and
    the ``TAGS`` most frequent tags.
    """
    n = pages.count()
    share = int(1_000_000 * min(1.0, sample / max(n, 1)))
    rows = pages.where(F.col(page).isNotNull() & (F.pmod(F.xxhash64(key), F.lit(1_000_000)) < share)).select(F.col(page).alias("html"))
    found = stored(mapped(rows, _counted, "features string, content boolean, n long").groupBy("features", "content").agg(
        F.sum("n").alias("n")), "html-counts")
    is_tag = F.col("features").startswith("<")
    counts = found.where(~is_tag).orderBy("features", "content").collect()
    if not counts:
        return Weights()
    tags = found.where(is_tag).groupBy("features").agg(
        F.sum(F.when(F.col("content"), F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("n"))
    tags = tags.orderBy(F.desc("n"), "features").limit(TAGS).collect()
    x = np.array([[int(c) for c in r["features"]] for r in counts], float)
    y = np.array([r["content"] for r in counts], float)
    # a page speaks for itself once, not once per word
    words = np.array([r["n"] for r in counts], float)
    size = words * (1000.0 / words.sum())
    w = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (size * (y - p)) - RIDGE * (w - PRIOR)
        step = np.linalg.solve((x * (size * p * (1 - p))[:, None]).T @ x + np.diag(RIDGE), grad)
        w = w + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    # a tag costs the logarithm of its chance to stand in content, if content and the rest were equally long
    inside, outside = words[y == 1].sum() + 1, words[y == 0].sum() + 1
    costs = {}
    for r in tags:
        a, b = (r["inside"] + 0.5) / inside, (r["n"] - r["inside"] + 0.5) / outside
        costs[r["features"][1:]] = float(np.clip(np.log(a / (a + b)), -3.0, -0.01))
    return Weights(w, costs)


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", weights: Weights | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    weights = weights or trained(pages, key, page)
    word, tags = weights.word, weights.tags

    def run(batches):
        w = Weights(word, tags)
        for pdf in batches:
            texts = [extract(h, w) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    rows = pages.select(F.col(key).cast("string").alias("id"), F.col(url).alias("url"), F.coalesce(F.col(page), F.lit("")).alias("html"))
    return mapped(rows, run, "page_id string, url string, text string, n_chars long").withColumn("page_id", F.col("page_id").cast("long"))
