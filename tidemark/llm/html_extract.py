"""Main text of HTML pages: the best-scoring contiguous run of a page.

A page is a sequence of words and tags.  Tags score negative; words score by the elements they
stand in, with weights learned from labelled pages (log odds of a word being content, by tag
names and by the words in class, id and role).  One linear scan finds the contiguous run of the
highest sum.  Words of the run that stand in an element of clearly negative weight (an advert
inside the article, a comment) are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: What stands in these is no markup; its text is not part of the page's text.
RAW = frozenset("script style title textarea iframe noembed noframes xmp template noscript".split())
#: Never shown, even where their closing tag is missing.
CODE = frozenset(("script", "style"))
#: Elements whose words are no running text: labels, choices, and what stands in for a player.
ASIDE = frozenset("svg canvas audio video select".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
ARTICLE = frozenset(("article", "main"))

# Words in class, id or role of the labelled pages.
AROUND = (
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert warning popup modal overlay toast "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations trending popular more breadcrumb breadcrumbs crumbs menu menus nav navbar navigation "
    "topbar toolbar sidebar side rail widget widgets comment comments commentlist discussion disqus respond reply replies reviews feedback pagination pager toc skip search copyright legal disclaimer "
    "footer foot bottom masthead header head form contact complementary contentinfo search hidden"
).split()
INSIDE = "content article post entry story body text main maincontent articlebody".split()
AROUND_TAGS = "nav header footer aside form button dialog menu fieldset address".split()
INSIDE_TAGS = "article main p h1 h2 h3 h4 h5 h6 blockquote pre li table figure figcaption section".split()

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def names_of(tag: str, attrs: str, inside: bool) -> list[str]:
    """Names of an element that have weights; a header or footer inside an article has names of its own."""
    out = [tag]
    if attrs:
        for m in _NAMES.finditer(attrs):
            out += ["." + p.lower() for p in _PARTS.findall(m[1] or m[2] or m[3] or "")]
        if _HIDDEN.search(attrs):
            out.append(".hidden")
    if inside:
        out = ["inner " + n if n in ("header", ".header", ".head") else n for n in out]
    return out


#: Elements that may hold anything.
_NEUTRAL = INLINE | {"html", "body", "div", "ul", "ol"}


@dataclass(frozen=True)
class Weights:
    #: Log odds of content, by name of an element.
    names: dict[str, float]
    #: Of a word in none of these.
    plain: float
    #: What a tag costs.
    tags: dict[str, float]
    other_tag: float
    #: At this weight or less an element is left out.
    cut: float = -1.5
    #: Words of a left-out element that count in the scan.
    most: int = 5


@dataclass
class Piece:
    """A run of text with the weights above it, or a tag."""

    text: str = ""
    low: float = 0.0
    high: float = 0.0
    names: tuple = ()
    tag: str = ""
    content: bool = False


def pieces(page: str, weights: Weights | None = None, labelled: bool = False):
    """Text runs and tags of a page in order; ``labelled`` also keeps names and ``data-content``."""
    known: dict = {}
    stack: list[tuple] = [("", 0.0, 0.0, False, (), False)]  # tag, low, high, in an article, names, content
    at, n = 0, len(page)
    ends: dict[str, int] = {}  # of raw and aside elements: where the last closing tag that was looked up begins
    while at < n:
        m = _TOKEN.search(page, at)
        start = m.start() if m else n
        if start > at:
            top = stack[-1]
            yield Piece(page[at:start], top[1], top[2], top[4], "", top[5])
        if not m:
            return
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag, attrs = tag.lower(), (m["attrs"] or m["attrs2"] or "").strip()
        closed, attrs = attrs.endswith("/"), attrs.rstrip("/")
        if m["end"] or m["end2"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            yield Piece(tag=tag)
            continue
        yield Piece(tag=tag)
        if tag in RAW and not closed:
            closing = None
            if ends.get(tag, 0) < n:
                closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                ends[tag] = closing.start() if closing else n
            at = closing.end() if closing else n if tag in CODE else at
            continue
        if tag in ASIDE:
            # one that is not closed before the next of its name holds nothing
            if not closed and ends.get(tag, 0) < n:
                nearest = re.compile(rf"<(/?){tag}(?=[\s/>])", re.I).search(page, at)
                ends[tag] = nearest.start() if nearest else n
                closed = not nearest or not nearest[1]
            else:
                closed = True
        if tag in VOID or closed and tag in ASIDE | {"math", "object"}:
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] not in INLINE:
                    break
        elif tag in SIBLINGS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in SIBLINGS[tag]:
                    break
                if stack[k][0] == tag or {tag, stack[k][0]} in ({"dt", "dd"}, {"td", "th"}):
                    del stack[k:]
                    break
        above = stack[-1]
        key = tag, attrs, above[3]
        if key not in known:
            names = names_of(*key)
            found = [weights.names[x] for x in names if x in weights.names] if weights else []
            known[key] = min(found, default=0.0), max(found, default=0.0), tuple(names)
        low, high, names = known[key]
        stack.append((tag, min(low, above[1]), max(high, above[2]), above[3] or tag in ARTICLE, (*above[4], *names) if labelled else (), above[5] or (labelled and "data-content" in attrs)))


def best_run(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the highest sum (the first and longest of equal ones); one scan."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total < 0:
            total, start = 0.0, k
        total += s
        if total > best or total == best and total > 0 and start == best_at[0]:
            best, best_at = total, (start, k + 1)
    return best_at


def extract(page: str, weights: Weights) -> str:
    """Main text of a page, its blocks joined by one space."""
    items, scores, kept = [], [], []
    for p in pieces(page, weights):
        if p.tag:
            score, keep = -weights.tags.get(p.tag, weights.other_tag), True
        else:
            text = html.unescape(p.text) if "&" in p.text else p.text
            n = len(text.split())
            keep = p.low > weights.cut
            score = n * max(weights.plain + p.high + p.low, -1.0) if keep else min(n, weights.most) * max(p.low, -1.0)
            p.text = text
        items.append(p)
        scores.append(score)
        kept.append(keep)
    a, b = best_run(scores)
    if a == b:  # no word stands in an element of positive weight: all but the left-out ones count
        a, b = best_run([float(len(p.text.split())) if keep and not p.tag else min(s, 0.0) for p, s, keep in zip(items, scores, kept)])
    blocks, block = [], []
    for p, keep in zip(items[a:b], kept[a:b]):
        if not p.tag:
            if keep:
                block.append(p.text)
        elif p.tag == "br":
            block.append(" ")
        elif p.tag not in INLINE:
            blocks.append("".join(block))
            block = []
    blocks.append("".join(block))
    return " ".join(w for x in blocks if (w := " ".join(x.split())))


def labelled_pages() -> list[str]:
    """Small pages made by rule; elements with ``data-content`` hold the article."""
    line = "one two three four five six seven eight nine ten eleven twelve"
    article = f"<h1>{line}</h1><p>{line} <b>{line}</b> <a href='x'>{line}</a></p><p>{line}<br>{line}</p>" + "".join(f"<{t}>{line} {line}</{t}>" for t in INSIDE_TAGS[3:])
    shells = [f"<article data-content>{article}</article>", f"<main data-content><article>{article}</article></main>", f"<main><section data-content>{article}</section></main>", f"<div data-content>{article}</div>"]
    shells += [f"<div class='{name}' data-content>{article}</div>" for name in INSIDE]
    shells += [f"<article data-content><header><h1>{line}</h1></header><div class='header'>{line}</div><div class='head'>{line}</div>{article}</article>"]
    pages = []
    for k, name in enumerate(AROUND):
        shell = shells[k % len(shells)]
        tag = AROUND_TAGS[k % len(AROUND_TAGS)]
        links = "".join(f"<li><a href='x'>{line}</a></li>" for _ in range(2))
        before, after = f"<nav><ul>{links}</ul></nav><header>{line} {line}</header>", f"<footer>{line} {line}</footer>"
        pages.append(f"<html><body>{before}<div>{line}</div><div class='{name}'>{line}<p>{line}</p></div>{shell}<{tag}>{line}</{tag}><div id='{name}'><p>{line}</p></div>{after}</body></html>")
    return pages


def learned(pages_: list[str] | None = None, smoothing: float = 1.0) -> Weights:
    """Weights from labelled pages: log odds, and the cost of tags by how often they stand outside the content.

    Names that count against an element are found first; the other names are then weighed by the
    words outside of those, so that a paragraph in a menu says nothing about paragraphs.
    """
    runs, tag_in, tag_out = [], Counter(), Counter()
    for page in pages_ if pages_ is not None else labelled_pages():
        content = False
        for p in pieces(page, None, labelled=True):
            if p.tag:
                (tag_in if content else tag_out)[p.tag] += 1
            else:
                content = p.content
                runs.append((content, len(p.text.split()), set(p.names) - _NEUTRAL))

    def odds(against: set) -> dict[str, float]:
        inside, outside = Counter(), Counter()
        for content, n, names in runs:
            if content or not names & against:
                for name in names:
                    (inside if content else outside)[name] += n
        prior = math.log((sum(n for c, n, _ in runs if c) + smoothing) / (sum(n for c, n, x in runs if not c and not x & against) + smoothing))
        return {n: max(-4.0, min(4.0, math.log((inside[n] + smoothing) / (outside[n] + smoothing)) - min(prior, 0.0))) for n in {*inside, *outside}}

    against = {n: r for n, r in odds(set()).items() if r <= -2}
    names = {n: r for n, r in odds(set(against)).items() if r > 0} | against
    share = {t: (tag_out[t] + 1) / (tag_in[t] + tag_out[t] + 2) for t in {*tag_in, *tag_out}}
    names |= dict.fromkeys(ASIDE, -4.0)
    return Weights(names, plain=-0.25, tags={t: 0.2 * s**2 for t, s in share.items()}, other_tag=0.05)


def extracted(pages_: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``pages_`` with ``text`` and ``n_chars`` (its code points); columns of these names are replaced.

    Null or empty html, and a page without a word outside left-out elements, give an empty text.
    Nothing is cut short or capped; rows are judged one by one and never moved.
    """
    shared = pages_.sparkSession.sparkContext.broadcast(weights or learned())

    def run(column: pa.Array) -> pa.Array:
        texts = [extract(page.as_py() or "", shared.value) for page in column]
        return base.struct(text=pa.array(texts, pa.string()), n_chars=pa.array([len(t) for t in texts], pa.int64()))

    return base.with_results(pages_, F.arrow_udf(run, "text string, n_chars long")(F.col("html")), ["text", "n_chars"])
