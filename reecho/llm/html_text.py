"""Main text of web pages: boosted trees over DOM-node features, decoded along the tree.

Each block element and each run of text is a node. The trees give the log-odds that it belongs to the article, from its
tag, attribute words, depth, text density of its subtree, links, and how it stands among its siblings. Decoding picks the best
choice of kept, dropped and mixed subtrees as a whole: a kept node keeps and a dropped node drops all below it.

Training pages are of two kinds, both bounded: pages made from a grammar of layouts, where every label is known, and a sample of
the given pages, where sectioning elements and attribute words of clear meaning label what is below them.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reecho.llm import boosting
from reecho.llm.common import ship

# Attributes as HTML reads them: a quote opens a value only where a value begins.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[\s/]+|=|[^\s=>/]+(?:\s*=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]+)?)?)*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(class|id|role|aria-label|aria-hidden|hidden|style|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)
WORD = re.compile(r"[a-z]+")

# HTML's element groups.
RAW = ("script", "style", "textarea", "title")
UNSEEN = ("noscript", "template", "iframe", "svg", "select", "button", "object", "noframes")
VOID = ("br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr")
INLINE = (
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
)
TAGS = (
    "#text", "body", "article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd",
    "table", "tbody", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "nav", "header", "footer", "aside", "form", "fieldset", "address",
)
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    **{h: {"p"} for h in ("h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "div", "table", "section", "article", "main", "nav", "header", "footer", "aside", "form", "blockquote", "pre", "figure", "dl", "address", "hr")},
}
BOUNDARY = {"li": {"ul", "ol"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table", "tbody"}, "dt": {"dl"}, "dd": {"dl"}, "p": {"div", "td", "li", "article", "section", "main", "aside", "form", "blockquote", "body", "footer", "header", "nav"}}

# Attribute words by what they usually mark.
ASIDE = {
    "ad", "ads", "advert", "adverts", "advertisement", "adbox", "promo", "promotion", "sponsor", "sponsored", "banner", "cookie", "cookies",
    "consent", "gdpr", "nav", "navbar", "navigation", "menu", "sidebar", "side", "footer", "foot", "header", "masthead", "topbar", "comment",
    "comments", "reply", "replies", "discussion", "disqus", "share", "sharing", "social", "related", "recommended", "recommendations",
    "newsletter", "subscribe", "subscription", "signup", "login", "search", "breadcrumb", "breadcrumbs", "pagination", "pager", "widget",
    "popup", "modal", "overlay", "notice", "alert", "toolbar", "copyright", "legal", "hidden", "none", "form", "teaser", "tags",
}
BODY = {"article", "content", "post", "entry", "story", "text", "main", "maincontent", "articlebody", "prose", "body"}
ASIDE_TAGS = {"nav", "header", "footer", "aside", "form", "fieldset"}
BODY_TAGS = {"article", "main"}


PAGES_AT_ONCE = 256


@dataclass(frozen=True)
class HtmlParams:
    """``made``: pages from the grammar; ``sample``: about so many given pages are used for the fit."""

    made: int = 400
    sample: int = 300
    trees: int = 40
    depth: int = 4
    mixing: float = 1.0
    seed: int = 3


@dataclass(eq=False, slots=True)
class Node:
    tag: str
    parent: "Node | None"
    words: frozenset[str] = frozenset()
    children: list["Node"] = field(default_factory=list)
    text: str = ""
    linked: int = 0
    chars: int = 0
    links: int = 0
    leaves: int = 0
    elements: int = 0
    stops: int = 0
    controls: int = 0
    depth: int = 0
    place: int = 0
    alike: int = 1
    bad: int = 0
    good: int = 0


_KIND = {tag: i for i, tag in enumerate(TAGS)}


def attribute_words(raw: str) -> frozenset[str]:
    if not raw:
        return frozenset()
    found: set[str] = set()
    for name, *values in ATTRIBUTE.findall(raw):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            found.add("hidden")
        elif name == "style":
            if re.search(r"display\s*:\s*none", value):
                found.add("hidden")
        elif name not in ("aria-hidden", "style"):
            found.update(WORD.findall(value))
    return frozenset(found)


def parse(source: str) -> Node:
    """Tree of block elements and text runs. Inline tags only mark links; scripts, styles and the like are left out."""
    root = Node("body", None)
    at, pieces, linked, in_link, position = root, [], 0, False, 0

    def flush() -> None:
        nonlocal pieces, linked
        text = " ".join("".join(pieces).split())
        if text:
            at.children.append(Node("#text", at, text=text, linked=min(linked, len(text))))
        pieces, linked = [], 0

    while position < len(source):
        m = TOKEN.search(source, position)
        raw = source[position : m.start() if m else len(source)]
        if raw:
            plain = html.unescape(raw)
            pieces.append(plain)
            if in_link:
                linked += len(plain)
        if not m:
            break
        position = m.end()
        closing, tag = m[1], (m[2] or "").lower()
        if not tag:
            continue
        if tag in RAW and not closing:
            if not (m[3] or "").endswith("/"):
                end = re.compile(rf"</{tag}\s*>", re.I).search(source, position)
                position = end.end() if end else len(source)
            pieces.append(" ")
            at.controls += tag == "textarea"
        elif tag in UNSEEN and not closing:
            # left out up to its end; one that no end follows before another of its kind, or at all, is taken as never opened
            end = re.compile(rf"<(/?){tag}(?![A-Za-z0-9:-])[^>]*>", re.I).search(source, position)
            if end and end[1] and not (m[3] or "").endswith("/"):
                position = end.end()
            pieces.append(" ")
            at.controls += tag in ("select", "button")
        elif tag == "a":
            in_link = not closing
        elif tag in VOID:
            pieces.append(" ")
            at.controls += tag == "input"
            if tag == "hr":
                flush()
        elif tag in INLINE or tag in ("html", "head", "body", *RAW, *UNSEEN):
            if tag in ("body", "head"):
                flush()
        elif closing:
            flush()
            in_link = False
            up = at
            while up.parent and up.tag != tag:
                up = up.parent
            if up.tag == tag and up.parent:
                at = up.parent
        else:
            flush()
            in_link = False
            up = at
            while up.parent and up.tag not in BOUNDARY.get(tag, ()):
                if up.tag in CLOSES.get(tag, ()):
                    at = up.parent
                    break
                if tag not in BOUNDARY and up.tag != "p":
                    break
                up = up.parent
            node = Node(tag, at, attribute_words(m[3]))
            at.children.append(node)
            at = node
    flush()
    return root


def in_order(root: Node) -> list[Node]:
    """All nodes, parents before children, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(node.children))
    return out


def _bin(value: float) -> int:
    """Floor of log2 of the value and one, 15 at most."""
    return min(15, int(value + 1).bit_length() - 1)


def features(nodes: list[Node]) -> np.ndarray:
    """Small non-negative integers, one row per node; ``nodes`` as given by ``in_order``."""
    for node in reversed(nodes):
        if node.tag == "#text":
            node.chars, node.links, node.leaves = len(node.text), node.linked, 1
            node.stops = node.text.count(".") + node.text.count(",") + node.text.count("?") + node.text.count("!")
        for child in node.children:
            node.chars += child.chars
            node.links += child.links
            node.leaves += child.leaves
            node.elements += child.elements + (child.tag != "#text")
            node.stops += child.stops
            node.controls += child.controls
    page = max(1, nodes[0].chars)
    rows = []
    for node in nodes:
        up, chars = node.parent, node.chars
        bad = bool(node.words & ASIDE) + 2 * (node.tag in ASIDE_TAGS)
        good = bool(node.words & BODY) + 2 * (node.tag in BODY_TAGS)
        outer_bad, outer_good = (up.bad, up.good) if up else (0, 0)
        node.bad, node.good = outer_bad | bad, outer_good | good
        same: dict[str, int] = {}
        for i, child in enumerate(node.children):
            same[child.tag] = same.get(child.tag, 0) + 1
            child.depth, child.place = node.depth + 1, i
        for child in node.children:
            child.alike = same[child.tag]
        siblings = len(up.children) if up else 1
        rows.append((
            _KIND.get(node.tag, len(TAGS)),
            min(node.depth, 15),
            _bin(chars),
            round(7 * node.links / max(1, chars)),
            _bin(chars / (node.elements + 1)),
            bad, good, outer_bad, outer_good,
            _bin(siblings), round(7 * node.place / (siblings - 1)) if siblings > 1 else 0, _bin(node.alike),
            round(7 * chars / max(1, up.chars if up else page)),
            min(15, round(100 * node.stops / max(1, chars))),
            _bin(chars / max(1, node.leaves)),
            round(15 * chars / page),
            _KIND.get(up.tag, len(TAGS)) if up else 0,
            min(node.controls, 3),
        ))
    return np.array(rows, np.int64)


def decode(nodes: list[Node], log_odds: np.ndarray, mixing: float) -> list[str]:
    """Texts of the kept runs, in page order."""
    gain = {
        id(n): s * (1 + math.log1p(n.chars) / 4) for n, s in zip(nodes, np.clip(log_odds, -4, 4).tolist(), strict=True)
    }
    keep: dict[int, float] = {}
    best: dict[int, tuple[float, str]] = {}
    for node in reversed(nodes):
        own = gain[id(node)]
        if not node.children:
            keep[id(node)] = own
            best[id(node)] = (own, "keep") if own > 0 else (0.0, "drop")
            continue
        kept = own + sum([keep[id(c)] for c in node.children])
        mixed = sum([best[id(c)][0] for c in node.children]) - mixing
        keep[id(node)] = kept
        best[id(node)] = max((kept, "keep"), (0.0, "drop"), (mixed, "mix"))
    out, stack = [], [(nodes[0], False)]
    while stack:
        node, kept = stack.pop()
        choice = "keep" if kept else best[id(node)][1]
        if choice == "drop":
            continue
        if choice == "keep" and node.tag == "#text":
            out.append(node.text)
        stack.extend((c, choice == "keep") for c in reversed(node.children))
    return out


def clear_labels(nodes: list[Node]) -> np.ndarray:
    """1 below article and main, 0 below marked side matter, whichever is nearer; -1 where nothing tells.

    A node around both kinds is left open.
    """
    label: dict[int, int] = {}
    for node in nodes:
        inherited = label[id(node.parent)] if node.parent else -1
        if inherited == 0:
            label[id(node)] = 0
        elif node.tag in ASIDE_TAGS or node.words & ASIDE:
            label[id(node)] = 0
        elif node.tag in BODY_TAGS:
            label[id(node)] = 1
        else:
            label[id(node)] = inherited
    return np.array([label[id(n)] for n in nodes])


class Layouts:
    """Pages from a small grammar of layouts. Runs of the article begin with a mark that is taken off again."""

    MARK = ""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.words = ["".join(self.rng.choices("aeioutnrslhd", k=self.rng.randint(2, 9))) for _ in range(600)]

    def said(self, least: int, most: int, stops: bool = True) -> str:
        words = self.rng.choices(self.words, k=self.rng.randint(least, most))
        return " ".join(words).capitalize() + (self.rng.choice(".....!?:") if stops else "")

    def sentences(self, n: int) -> str:
        return " ".join(self.said(4, 18) for _ in range(self.rng.randint(1, n)))

    def named(self, *names: str) -> str:
        pick = self.rng.choice(["", "", *names, f"c{self.rng.randint(1, 99)} x"])
        return f' {self.rng.choice(["class", "id"])}="{pick}"' if pick else ""

    def links(self, most: int) -> str:
        items = "".join(f'<li><a href="/x">{self.said(1, 4, False)}</a></li>' for _ in range(self.rng.randint(2, most)))
        return f"<ul>{items}</ul>"

    def side(self) -> str:
        pick = self.rng.randint(0, 9)
        if pick == 0:
            return f"<nav>{self.links(9)}</nav>"
        if pick == 1:
            return f'<div{self.named("menu", "navbar", "breadcrumbs")}>{self.links(7)}</div>'
        if pick == 2:
            return f'<div class="{self.rng.choice(["ad", "promo", "sponsored", "banner"])}">{self.said(3, 14)}</div>'
        if pick == 3:
            return f'<aside{self.named("sidebar")}><h3>{self.said(1, 3, False)}</h3>{self.links(6)}<p>{self.said(3, 12)}</p></aside>'
        if pick == 4:
            return f'<div class="{self.rng.choice(["cookie-notice", "notice", "alert", "consent", "newsletter"])}"><p>{self.sentences(2)}</p><button>ok</button></div>'
        if pick == 5:
            body = "".join(f'<div class="{self.rng.choice(["comment", "reply", ""])}"><b>{self.said(1, 2, False)}</b><p>{self.sentences(4)}</p></div>' for _ in range(self.rng.randint(1, 6)))
            tag = self.rng.choice(["div", "section", "ul"])
            return f'<{tag} {self.rng.choice(["class", "id"])}="{self.rng.choice(["comments", "discussion", "replies", "user-comments"])}"><h2>{self.said(1, 3, False)}</h2>{body}</{tag}>'
        if pick == 6:
            return f'<form action="/s"><label>{self.said(1, 3, False)}</label><input name="q"><p>{self.said(3, 12)}</p><input type="submit"></form>'
        if pick == 7:
            return f'<div class="{self.rng.choice(["related", "recommended", "share", "social"])}"><h4>{self.said(1, 4, False)}</h4>{self.links(6)}</div>'
        if pick == 8:
            return f'<footer><p>&copy; {self.said(2, 9)}</p>{self.links(4)}</footer>'
        return f'<header{self.named("masthead")}><h2>{self.said(1, 3, False)}</h2><p>{self.said(2, 8)}</p></header>'

    def part(self) -> str:
        pick, m = self.rng.randint(0, 13), self.MARK
        if pick == 0:
            return f"<h{self.rng.randint(2, 4)}>{m}{self.said(2, 8, False)}</h2>"
        if pick == 1:
            items = "".join(f"<li>{m}{self.said(3, 14)}</li>" for _ in range(self.rng.randint(2, 5)))
            return f"<ul>{items}</ul>"
        if pick == 2:
            return f"<blockquote><p>{m}{self.sentences(3)}</p></blockquote>"
        if pick == 3:
            return f'<p>{m}{self.said(3, 9)} <a href="/y">{self.said(1, 4, False)}</a> {self.said(3, 9)}</p>'
        if pick == 4:
            return f"<p>{m}{self.said(1, 3)}</p>"
        if pick == 5:
            return f"<p><b>{m}{self.sentences(4)}<br>"
        if pick == 6:
            cells = "".join(f"<tr><td>{m}{self.said(1, 4, False)}</td><td>{m}{self.said(1, 4, False)}</td></tr>" for _ in range(2))
            return f"<table>{cells}</table>"
        return f"<p>{m}{self.sentences(6)}</p>"

    def page(self) -> str:
        parts = [f"<h1>{self.MARK}{self.said(3, 9, False)}</h1>"] if self.rng.random() < 0.8 else []
        for _ in range(self.rng.randint(1, 14)):
            parts.append(self.part())
            if self.rng.random() < 0.06:
                parts.append(self.side())
        shell = self.rng.choice(["article", "article", "main", "div", "div", "section", ""])
        body = "".join(parts)
        if shell:
            name = self.named("content", "post", "entry-content", "article-body", "story", "main") if shell != "article" else self.named("post", "h-entry")
            body = f"<{shell}{name}>{body}</{shell}>"
        if self.rng.random() < 0.4:
            body = f'<div{self.named("wrapper", "container", "page")}>{"".join(self.side() for _ in range(self.rng.randint(0, 2)))}{body}{"".join(self.side() for _ in range(self.rng.randint(0, 2)))}</div>'
        before = "".join(self.side() for _ in range(self.rng.randint(0, 4)))
        after = "".join(self.side() for _ in range(self.rng.randint(0, 4)))
        return f"<html><head><title>{self.said(2, 8, False)}</title></head><body>{before}{body}{after}</body></html>"

    def example(self) -> tuple[np.ndarray, np.ndarray]:
        """Features and labels of one page's nodes; nodes around both kinds are -1."""
        nodes = in_order(parse(self.page()))
        kinds: dict[int, set[int]] = {}
        for node in reversed(nodes):
            own = {int(node.text.startswith(self.MARK))} if node.tag == "#text" else set()
            node.text = node.text.removeprefix(self.MARK)
            kinds[id(node)] = own.union(*[kinds[id(c)] for c in node.children])
        labels = np.array([next(iter(kinds[id(n)])) if len(kinds[id(n)]) == 1 else -1 for n in nodes])
        return features(nodes), labels


def fit_judge(pages: DataFrame, params: HtmlParams) -> boosting.Boosted:
    layouts = Layouts(params.seed)
    examples = [layouts.example() for _ in range(params.made)]
    total = max(1, pages.count())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source in batch["html"]:
                nodes = in_order(parse(source))
                rows, labels = features(nodes), clear_labels(nodes)
                known = labels >= 0
                if known.any():
                    yield pd.DataFrame({"bins": list(rows[known]), "label": labels[known]})

    chosen = pages.where("html is not null").where(F.rand(params.seed) < params.sample / total).select("html")
    seen = chosen.mapInPandas(run, "bins array<bigint>, label int").toPandas()
    bins, labels = np.concatenate([e[0] for e in examples]), np.concatenate([e[1] for e in examples])
    weights = np.ones(len(labels))
    if len(seen):
        # both kinds of pages weigh alike
        share = len(labels) / len(seen)
        bins, labels = np.concatenate([bins, np.stack(list(seen["bins"]))]), np.concatenate([labels, seen["label"]])
        weights = np.concatenate([weights, np.full(len(seen), share)])
    known = labels >= 0
    return boosting.fit(bins[known], labels[known].astype(float), weights[known], params.trees, params.depth)


def main_texts(sources: list[str | None], judge: boosting.Boosted, mixing: float) -> list[str]:
    """Main text of each page; the trees judge all their nodes together."""
    trees = [in_order(parse(source)) if source else [] for source in sources]
    rows = [features(nodes) for nodes in trees if nodes]
    scores = judge.log_odds(np.concatenate(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for nodes in trees:
        out.append("\n\n".join(decode(nodes, scores[at : at + len(nodes)], mixing)) if nodes else "")
        at += len(nodes)
    return out


def extract(pages: DataFrame, params: HtmlParams = HtmlParams()) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per input row.

    Blocks of the article in page order, joined by an empty line; references are decoded and white space inside a block
    is one space. Null, empty and textless pages give an empty text. Repeated rows are extracted each for itself;
    other columns are not looked at.
    """
    ship(pages.sparkSession)
    judge = pages.sparkSession.sparkContext.broadcast(fit_judge(pages, params))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), PAGES_AT_ONCE):
                part = batch.iloc[at : at + PAGES_AT_ONCE]
                texts = main_texts([s if isinstance(s, str) else None for s in part["html"]], judge.value, params.mixing)
                yield pd.DataFrame({
                    "page_id": part["page_id"].astype("Int64"), "url": part["url"], "text": texts, "n_chars": [len(t) for t in texts]
                })

    source = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return source.mapInPandas(run, "page_id bigint, url string, text string, n_chars bigint")
