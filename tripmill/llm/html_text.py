"""Main text of web pages by a tree-structured graphical model.

A page becomes a tree of its block elements with text blocks as leaves. Every node is content or
not: its own features give a unary potential, and parents and children are tied by a pairwise
potential. Sum-product messages go up and then down the tree and give each node's marginal; the
text blocks whose content marginal is above one half are the main text. Potentials are learned
from pages that mark their article themselves, on top of a fixed prior.
"""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import arrow_rows, stored

#: Labelled pages that the potentials are fitted to, chosen by hash.
SAMPLE = 400

# Elements by role in HTML.
BLOCKS = set(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr caption"
    " blockquote pre section article main nav header footer aside address figure figcaption"
    " form fieldset details summary dialog menu center hr".split()
)
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
UNSEEN = RAW | {"head", "template", "svg", "math", "button", "select", "object", "canvas", "audio",
                "video", "form", "dialog", "menu"}
SPACED = {"br", "td", "th", "img", "wbr", "option"}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
    "thead": {"thead", "tbody", "tr"}, "tbody": {"thead", "tbody", "tr"}, "tfoot": {"tbody", "tr"},
}
KEEPS_OPEN = {"ul", "ol", "dl", "table", "div", "section", "article", "body"}
ASIDES = set(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted"
    " promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar side rail widget footer"
    " foot header masthead topbar toolbar comment comments respond reply replies discussion disqus"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter"
    " subscribe subscription signup login share sharing social related recommended recommendations"
    " popular trending more tags tagcloud pagination pager skip copyright legal disclaimer search"
    " form outbrain taboola paywall toc metadata byline".split()
)
CONTENTS = set("article content post entry story main body text articlebody".split())
ARTICLE = {"article", "main"}
BOILER_TAGS = {"nav": -7.0, "footer": -7.0, "aside": -7.0, "header": -3.0, "address": -2.0}

#: Quotes count after = only. One that nothing closes counts for nothing: the tag ends at the next >
#: or with the page. Every run after <letter matches, so no tag becomes text.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)"
    r"((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[\"']|))*+)(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_ARIA = {"navigation": "nav", "banner": "header", "contentinfo": "footer", "complementary": "aside",
         "main": "main", "search": "form", "dialog": "dialog"}


class Node:
    """A block element, or a text block (tag "#text")."""

    __slots__ = ("tag", "parent", "words", "text", "linked")

    def __init__(self, tag: str, parent: int, words: frozenset, text: str = "", linked: int = 0):
        self.tag, self.parent, self.words, self.text, self.linked = tag, parent, words, text, linked


_NONE: frozenset = frozenset()


def tree_of(page: str) -> list[Node]:
    """The nodes of a page, parents first. Unseen elements leave nothing behind."""
    nodes = [Node("html", -1, _NONE)]
    stack, inner = [0], ["html"]
    hidden: list[str] = []  # open unseen elements
    text: list[str] = []
    linked, in_link, at, end = 0, False, 0, len(page)

    def close_block() -> None:
        nonlocal linked, in_link
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                nodes.append(Node("#text", stack[-1], _NONE, joined, linked))
            text.clear()
        linked, in_link = 0, False

    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at and not hidden:
            piece = page[at:stop]
            text.append(piece)
            if in_link:
                linked += len(piece.split())
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        closing, tag = bool(m[1]), m[2].lower()
        if tag in RAW and not closing:
            # its content is no markup
            found = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = found.end() if found else end
            if tag not in ("script", "style"):
                text.append(" ")
            continue
        if tag in UNSEEN:
            if closing:
                if tag in hidden:
                    del hidden[len(hidden) - 1 - hidden[::-1].index(tag) :]
            else:
                if not hidden:
                    close_block()
                if not m[3].rstrip().endswith("/"):
                    hidden.append(tag)
            continue
        if hidden:
            if tag == "body":  # a head that was not closed
                hidden.clear()
            else:
                continue
        if tag == "a":
            in_link = not closing
        elif tag in SPACED:
            text.append(" ")
        elif tag in BLOCKS:
            close_block()
            if closing:
                if tag in inner[1:]:
                    cut = len(inner) - 1 - inner[::-1].index(tag)
                    del stack[cut:], inner[cut:]
            elif tag not in ("html", "hr"):
                _imply_ends(tag, stack, inner)
                words, tag_as = _words(m[3], tag)
                nodes.append(Node(tag_as, stack[-1], words))
                if not (tag == "body" and "body" in inner):
                    stack.append(len(nodes) - 1)
                    inner.append(tag)
    close_block()
    return nodes


def _imply_ends(tag: str, stack: list[int], inner: list[str]) -> None:
    if inner[-1] == "p" or (inner[-1] in ("h1", "h2", "h3", "h4", "h5", "h6") and tag[0] == "h"):
        del stack[-1], inner[-1]
    while len(inner) > 1 and inner[-1] not in KEEPS_OPEN and inner[-1] in CLOSES.get(tag, ()):
        del stack[-1], inner[-1]


def _words(attributes: str, tag: str) -> tuple[frozenset, str]:
    """Words of class, id and role; the tag that a role or a hidden element stands for."""
    if not attributes or attributes.isspace():
        return _NONE, tag
    words: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                words.add("#hidden")
        elif name == "hidden":
            words.add("#hidden")
        elif name == "role":
            tag = _ARIA.get(value, tag)
        else:
            words.update(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value)))
    return frozenset(words), tag


# ---- potentials

# Log-odds of content before any page is seen; fitting moves them.
PRIOR = {
    "bias": 0.0, "aside-word": -8.0, "content-word": 2.5, "hidden": -9.0, "article": 6.0,
    "under-article": 4.5, "under-aside": -6.0, "no-article": 1.0, "link>0.6": -2.5, "link>0.3": -0.8, "words>20": 1.5,
    "words>6": 0.6, "sentence": 0.6, "heading": 0.5, "paragraph": 0.6, "list-link": -1.5,
    **{f"tag:{t}": w for t, w in BOILER_TAGS.items()},
}
#: Rows are the parent's state, columns the child's: log P(child | parent).
PRIOR_EDGE = ((math.log(0.8), math.log(0.2)), (math.log(0.1), math.log(0.9)))


def features(nodes: list[Node]) -> list[list[str]]:
    """Names of the features that hold for each node."""
    has_article = any(n.tag in ARTICLE for n in nodes)
    under, aside = [False] * len(nodes), [False] * len(nodes)
    out = []
    for k, n in enumerate(nodes):
        up = nodes[n.parent] if n.parent >= 0 else None
        inside = n.parent >= 0 and under[n.parent]
        under[k] = inside or n.tag in ARTICLE
        away = n.parent >= 0 and aside[n.parent]
        page_part = n.tag in ("nav", "footer", "aside") or (n.tag == "header" and not inside)
        aside[k] = away or page_part or bool(n.words & ASIDES)
        own = ["bias"] + ["under-aside"] * away
        if n.tag == "#text":
            size = len(n.text.split())
            share = n.linked / size if size else 0.0
            if share > 0.6:
                own.append("link>0.6")
            elif share > 0.3:
                own.append("link>0.3")
            own += ["words>20"] * (size > 20) + ["words>6"] * (size > 6)
            own += ["sentence"] * n.text.endswith((".", "!", "?", '"', "”", "…"))
            own += ["heading"] * (up.tag[0] == "h" and up.tag[1:].isdigit())
            own += ["paragraph"] * (up.tag in ("p", "pre", "blockquote"))
            own += ["list-link"] * (up.tag == "li" and share > 0.6)
            own.append("under-article" if inside else "" if has_article else "no-article")
        else:
            if n.words:
                own += ["aside-word"] * bool(n.words & ASIDES) + ["hidden"] * ("#hidden" in n.words)
                own += ["content-word"] * (bool(n.words & CONTENTS) and not n.words & ASIDES)
            if n.tag in ARTICLE:
                own.append("article")
            elif n.tag in BOILER_TAGS:
                own.append(f"tag:{n.tag}")
            if inside:
                own.append("under-article")
        out.append([f for f in own if f])
    return out


def marginals(nodes: list[Node], weights: dict[str, float], edge) -> list[float]:
    """P(content) of every node by sum-product messages up and down the tree."""
    unary = [sum(weights.get(f, 0.0) for f in own) for own in features(nodes)]
    n = len(nodes)
    up = [[0.0, u] for u in unary]  # own potential and the messages of all children
    message = [(0.0, 0.0)] * n
    for k in range(n - 1, 0, -1):
        off, on = up[k]
        message[k] = tuple(_add(edge[s][0] + off, edge[s][1] + on) for s in (0, 1))
        parent = up[nodes[k].parent]
        parent[0] += message[k][0]
        parent[1] += message[k][1]
    down: list[tuple[float, float]] = [(0.0, 0.0)] * n
    for k in range(1, n):
        p = nodes[k].parent
        # what the parent believes without this child
        rest = [up[p][s] + down[p][s] - message[k][s] for s in (0, 1)]
        down[k] = tuple(_add(rest[0] + edge[0][s], rest[1] + edge[1][s]) for s in (0, 1))
    odds = [up[k][1] + down[k][1] - up[k][0] - down[k][0] for k in range(n)]
    return [1 / (1 + math.exp(-max(min(o, 500.0), -500.0))) for o in odds]


def _add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a))


def labels(nodes: list[Node]) -> list[int] | None:
    """Content or not per node, if the page marks its article; else None."""
    if sum(n.tag in ARTICLE for n in nodes) != 1:
        return None
    out = []
    for n in nodes:
        inside = n.parent >= 0 and out[n.parent] == 1
        aside = n.tag in BOILER_TAGS or bool(n.words & ASIDES) or "#hidden" in n.words
        out.append(int((inside or n.tag in ARTICLE) and not aside))
    return out


def fit(pages: list[str], rounds: int = 60, rate: float = 0.5, pull: float = 0.02):
    """(weights, edge) from labelled pages: logistic unary weights pulled to the prior, and edges
    counted with the prior as strong as the pages.

    Every page is learned from twice, the second time with its article as a plain div, so that
    pages that mark nothing are read too.
    """
    rows: list[tuple[list[str], int]] = []
    counts = [[0, 0], [0, 0]]
    for page in pages:
        nodes = tree_of(page)
        truth = labels(nodes)
        if truth is None:
            continue
        rows += zip(features(nodes), truth)
        for n, t in zip(nodes, truth):
            if n.parent >= 0:
                counts[truth[n.parent]][t] += 1
            if n.tag in ARTICLE:
                n.tag = "div"
        rows += zip(features(nodes), truth)
    pairs = [
        [n + (sum(row) + 1) * math.exp(p) for n, p in zip(row, prior)]
        for row, prior in zip(counts, PRIOR_EDGE)
    ]
    weights = dict(PRIOR)
    groups: dict[tuple[str, ...], list[int]] = {}
    for own, t in rows:
        held = groups.setdefault(tuple(own), [0, 0])
        held[t] += 1
    total = max(len(rows), 1)
    for _ in range(rounds):
        slope: dict[str, float] = {}
        for own, (off, on) in groups.items():
            p = 1 / (1 + math.exp(-sum(weights.get(f, 0.0) for f in own)))
            step = (on - p * (on + off)) / total
            for f in own:
                slope[f] = slope.get(f, 0.0) + step
        for f, g in slope.items():
            w = weights.get(f, 0.0)
            weights[f] = w + rate * (g - pull * (w - PRIOR.get(f, 0.0)))
    edge = tuple(tuple(math.log(x / sum(row)) for x in row) for row in pairs)
    return weights, edge


def main_text(page: str, weights: dict[str, float], edge) -> str:
    """The text blocks of the page that are content, in order."""
    nodes = tree_of(page)
    if len(nodes) == 1:
        return ""
    likely = marginals(nodes, weights, edge)
    kept = [n.text for n, p in zip(nodes, likely) if n.tag == "#text" and p > 0.5]
    return "\n\n".join(kept)


EXTRACTED = "page_id bigint, url string, text string, n_chars bigint"


def extract(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(page_id, url, text, n_chars) per row of pages.

    Null and empty pages, and pages without content, have an empty text. Broken markup is read
    as far as it goes: unclosed elements end with their parents, unclosed comments and scripts
    with the page. Repeated rows give the same text; other columns are not read. Potentials are
    fitted on the driver to at most `sample` pages of up to 100,000 characters that mark their
    article; without such pages the prior holds alone.
    """
    texts = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    marked = texts.filter(F.lower("html").rlike("<(article|main)\\b") & (F.length("html") < 100_000))
    h = F.xxhash64("html")
    few = marked.select("html", h.alias("h")).withColumn("bin", F.pmod(F.xxhash64("h"), F.lit(sample)))
    few = few.groupBy("bin").agg(F.min_by("html", "h").alias("html"))
    model = fit([r["html"] for r in stored(few, "pages").orderBy("bin").collect()])

    def extract_batches(batches):
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html")]
            for page_id, url, page in zip(*columns):
                text = main_text(page, *model)
                rows.append((page_id, url, text, len(text)))
            yield arrow_rows(rows, EXTRACTED)

    return texts.mapInArrow(extract_batches, EXTRACTED)
