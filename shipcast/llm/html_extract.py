"""Main-text extraction: boosted trees score DOM nodes, a tree decoding makes
the choices agree.

A page becomes a tree of block elements and text blocks. Each node has
features of its subtree (text and link density, sentences), attribute tokens,
depth and siblings. Labels for training come from pages that say where their
article is (article or main elements, without the parts that are named as
something else); every training node is used twice, the second time with what
its names say hidden, so that the trees also learn the other features.
Decoding keeps the connected top part of the tree with the greatest sum of
scores, so no kept node has a dropped ancestor.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast.llm.boosting import Boosted

# HTML element names by their role, and words of class, id and role attributes.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SILENT = {"script", "style", "template", "noscript", "head", "title", "svg", "math", "iframe", "object", "canvas", "audio", "video", "select", "textarea", "datalist", "button"}
#: Elements that may stand in a head (any other tag, or text, ends it), and silent ones whose content is text, so that no tag in it counts.
HEAD_PARTS = {"html", "head", "base", "link", "meta", "title", "noscript", "script", "style", "template"}
RAW = {"script", "style", "title", "textarea"}
BLOCK = {"html", "body", "address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
         "hr", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}
FENCE = {"ul", "ol", "menu", "dl", "table", "td", "th", "div", "section", "article", "main", "aside", "nav", "header", "footer", "form", "body", "html", "blockquote"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ARTICLE = {"article", "main"}
OUTSIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset", "search"}
SIDE_WORDS = {"ad", "ads", "advert", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "discussion", "disqus",
              "footer", "gdpr", "header", "legal", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related", "replies", "reply",
              "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "teaser", "toolbar", "topbar", "tracking", "widget", "widgets"}
MAIN_WORDS = {"article", "articlebody", "body", "content", "entry", "main", "maincontent", "post", "story", "text"}

#: Pages that may say where their article is.
NAMES_ARTICLE = r"(?i)<(?:article|main)[\s/>]"
#: Bound on the pages that training reads: those with the least hash.
SAMPLE_PAGES = 600
#: Nodes of a training page that count; a longer page is thinned evenly.
SAMPLE_NODES = 400
#: Pages of other builds that each training page gives.
REBUILDS = 2

_token = re.compile(r"[a-z]+")
_space = re.compile(r"[\s\x00]+")
_sentence = re.compile(r"[.!?…。！？](?:\s|$)")


class Tree(HTMLParser):
    """Nodes of a page in document order: block elements and text blocks
    (tag ``#text``); parents come before children. Unclosed and stray tags
    are mended as browsers do in the common cases. A silent element without
    an end tag ends with the block around it."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.words, self.text, self.linked = [-1], ["#root"], [set()], [""], [0]
        self.open: list[tuple[str, int]] = []
        self.here = 0
        # Open silent elements, with the blocks inside them.
        self.silent: list[str] = []
        self.hidden = 0
        self.piece: list[str] = []
        self.link_chars = self.in_link = 0
        self.feed(html)
        self.close()
        self._flush()

    def _node(self, tag: str, words: set, text: str = "", linked: int = 0) -> int:
        self.parent.append(self.here)
        self.tag.append(tag)
        self.words.append(words)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.tag) - 1

    def _flush(self) -> None:
        text = _space.sub(" ", "".join(self.piece)).strip()
        if text:
            self._node("#text", set(), text, min(self.link_chars, len(text)))
        self.piece, self.link_chars = [], 0

    def _up(self, upto: int) -> None:
        self._flush()
        del self.open[upto:]
        self.here = self.open[-1][1] if self.open else 0

    def handle_starttag(self, tag, attrs, closed=False):
        if self.silent == ["head"] and tag not in HEAD_PARTS or self.silent[:1] == ["head"] and tag == "body":
            self.silent = []
        if self.silent:
            if not closed and (tag in SILENT or tag in BLOCK) and tag not in VOID and self.silent[-1] not in RAW:
                self.silent.append(tag)
            return
        if tag in SILENT:
            if not closed:
                self.silent.append(tag)
            self.piece.append(" ")
            return
        if tag == "br":
            self.piece.append(" ")
        elif tag in ("a",):
            self.in_link += 1
        if tag not in BLOCK:
            return
        self._flush()
        self.in_link = 0
        if self.open and self.open[-1][0] == "p":
            self._up(len(self.open) - 1)
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name in CLOSES.get(tag, ()):
                self._up(k)
            elif name in FENCE and not (name in ("td", "th") and tag in ("tr", "tbody", "tfoot")):
                break
        if tag in VOID:
            return
        said = " ".join(str(v) for n, v in attrs if n in ("class", "id", "role", "itemprop", "aria-label") and v)
        words = set(_token.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", said).lower()))
        if any(n in ("hidden",) or n == "aria-hidden" and v == "true" or n == "style" and v and re.search(r"display\s*:\s*none", v) for n, v in attrs):
            words = words | {"hidden"}
        self.here = self._node(tag, words)
        self.open.append((tag, self.here))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, closed=True)

    def handle_endtag(self, tag):
        if self.silent:
            raw = self.silent[-1] in RAW
            if tag in self.silent and (tag in SILENT or not raw):
                del self.silent[len(self.silent) - 1 - self.silent[::-1].index(tag):]
                return
            if raw or all(tag != name for name, _ in self.open):
                return
            self.silent = []
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag in BLOCK:
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == tag:
                    self._up(k)
                    return
            self._flush()

    def handle_data(self, data):
        if self.silent == ["head"] and data.strip():
            self.silent = []
        if not self.silent:
            self.piece.append(data)
            if self.in_link:
                self.link_chars += len(data)


FEATURES = 31
#: Places of the features that say what a node is named (hidden in half of the training nodes).
NAMED = slice(0, 12)


def features(tree: Tree) -> np.ndarray:
    """One row of features for each node."""
    n = len(tree.tag)
    parent = np.array(tree.parent)
    leaf = np.array([t == "#text" for t in tree.tag])
    chars = np.array([len(t) for t in tree.text], dtype=np.float64)
    linked = np.array(tree.linked, dtype=np.float64)
    ends = np.array([len(_sentence.findall(t)) for t in tree.text], dtype=np.float64)
    wordy = np.array([t.count(" ") + 1 if t else 0 for t in tree.text], dtype=np.float64)
    nodes, blocks = np.ones(n), leaf.astype(np.float64)
    upper = np.array([sum(map(str.isupper, t)) / max(1, len(t)) for t in tree.text])
    before = np.cumsum(chars) - chars
    for k in range(n - 1, 0, -1):
        p = parent[k]
        for total in (chars, linked, ends, wordy, nodes, blocks):
            total[p] += total[k]
    depth, place, kids = np.zeros(n), np.zeros(n), np.zeros(n)
    in_side, in_main, in_out, in_art = (np.zeros(n) for _ in range(4))
    hits = np.array([[len(w & SIDE_WORDS), len(w & MAIN_WORDS), "hidden" in w] for w in tree.words], dtype=np.float64)
    same: dict = {}
    out = np.zeros((n, FEATURES))
    for k in range(1, n):
        p = parent[k]
        depth[k] = depth[p] + 1
        place[k] = kids[p]
        kids[p] += 1
        in_side[k] = in_side[p] + (hits[k, 0] > 0)
        in_main[k] = in_main[p] + (hits[k, 1] > 0)
        in_out[k] = in_out[p] + (tree.tag[k] in OUTSIDE)
        in_art[k] = in_art[p] + (tree.tag[k] in ARTICLE)
        same[p, tree.tag[k]] = same.get((p, tree.tag[k]), 0) + 1
    top = max(chars[0], 1.0)
    up = np.maximum(parent, 0)
    sub_main = np.zeros(n)
    for k in range(n - 1, 0, -1):
        sub_main[k] = max(sub_main[k], tree.tag[k] in ARTICLE)
        sub_main[parent[k]] = max(sub_main[parent[k]], sub_main[k])
    out[:, 0:3] = hits
    out[:, 3], out[:, 4], out[:, 5], out[:, 6] = in_side, in_main, in_out, in_art
    out[:, 7] = [t in OUTSIDE for t in tree.tag]
    out[:, 8] = [t in ARTICLE for t in tree.tag]
    out[:, 9] = sub_main
    out[:, 10] = [bool(tree.words[k] & SIDE_WORDS) or tree.tag[k] in OUTSIDE for k in up]
    out[:, 11] = np.cumsum(out[:, 8]) > 0
    out[:, 12], out[:, 13], out[:, 14] = depth, place, kids
    out[:, 15] = kids[up]
    out[:, 16] = [same.get((parent[k], tree.tag[k]), 0) for k in range(n)]
    out[:, 17], out[:, 18] = np.log1p(chars), chars / top
    out[:, 19] = linked / np.maximum(chars, 1)
    out[:, 20] = ends / np.maximum(wordy, 1)
    out[:, 21] = wordy / np.maximum(blocks, 1)
    out[:, 22] = chars / np.maximum(nodes, 1)
    out[:, 23] = before / top
    out[:, 24] = chars / np.maximum(chars[up], 1)
    out[:, 25] = linked[up] / np.maximum(chars[up], 1)
    out[:, 26] = leaf
    out[:, 27] = [t in HEADINGS or tree.tag[k] in HEADINGS for t, k in zip(tree.tag, up)]
    out[:, 28] = [t in ("ul", "ol", "li", "menu") or tree.tag[k] == "li" for t, k in zip(tree.tag, up)]
    out[:, 29] = [t == "p" or tree.tag[k] == "p" for t, k in zip(tree.tag, up)]
    out[:, 30] = upper
    return out


def said_labels(tree: Tree, x: np.ndarray) -> np.ndarray | None:
    """1 for nodes with main text, by what the page itself says, else 0; null
    for pages that do not say it."""
    n = len(tree.tag)
    if not x[:, 8].any():
        return None
    y = np.array([t == "#text" for t in tree.tag]) & (x[:, 6] > 0) & (x[:, 3] == 0) & (x[:, 5] == 0) & (x[:, 2] == 0)
    y = y.astype(np.float64)
    for k in range(n - 1, 0, -1):
        y[tree.parent[k]] = max(y[tree.parent[k]], y[k])
    return y


#: Marks main blocks of a rebuilt page; a private character, taken out before features are made.
SIGN = "\ue000"


def rebuilt(tree: Tree, y: np.ndarray, seed: int) -> tuple[Tree, np.ndarray] | None:
    """A page of another build: the main blocks of ``tree`` in another frame,
    with parts that are not main before, after and between them."""
    pick = np.random.default_rng(seed)
    main = [t for t, g, k in zip(tree.text, y, tree.tag) if k == "#text" and g]
    side = [t for t, g, k in zip(tree.text, y, tree.tag) if k == "#text" and not g]
    if not main or not side:
        return None
    one = lambda options: options[int(pick.integers(len(options)))]
    chance = lambda share: pick.random() < share
    safe = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")
    side_words, main_words = sorted(SIDE_WORDS), sorted(MAIN_WORDS)

    def other() -> str:
        # Half of the time text of the article itself, so that its length tells nothing.
        return safe(one(side if chance(0.5) else main))

    def aside() -> str:
        word, kind = one(side_words), int(pick.integers(7))
        name = f'class="{word}"' if chance(0.5) else f'id="{word}-{int(pick.integers(9))}"'
        body = "".join(f"<p>{other()}</p>" for _ in range(int(pick.integers(1, 4))))
        return ("<aside>" + body + "</aside>", f"<div {name}>{body}</div>", f"<section {name}><h3>{other()}</h3>{body}</section>", f"<form>{body}<label>{other()}</label></form>",
                f"<div {name}>{other()}</div>", f"<ul {name}>" + "".join(f"<li><a href=x>{other()[:30]}</a>" for _ in range(5)) + "</ul>", f"<div {name}><div>{body}</div></div>")[kind]

    def block(t: str) -> str:
        t = SIGN + safe(t)
        return one([f"<p>{t}</p>"] * 6 + [f"<p>{t}", f"<div>{t}</div>", f"<h2>{t}</h2>", f"<blockquote><p>{t}</p></blockquote>", f"<table><tr><td>{t}</td></tr></table>", f"<ul><li>{t}</li></ul>", f"<section><p>{t}</p></section>", f"<pre>{t}</pre>"])

    parts = []
    if chance(0.3):
        cut = [SIGN + safe(t) for t in main]
        k = int(pick.integers(len(cut)))
        parts = [f"<p>{t}</p>" for t in cut[:k]] + ["<ul>" + "".join(f"<li>{t}" for t in cut[k:k + 6]) + "</ul>"] + [f"<p>{t}</p>" for t in cut[k + 6:]]
    else:
        parts = [block(t) for t in main]
    for _ in range(int(pick.integers(3))):
        parts.insert(int(pick.integers(len(parts) + 1)), aside())
    frame = one(["article", "main", "div", f'div class="{one(main_words)}"', f'div id="{one(main_words)}"', f'section class="{one(main_words)}"'])
    body = f"<{frame}>" + "".join(parts) + f"</{frame.split()[0]}>"
    if chance(0.3):
        body = f"<main>{body}</main>"
    before = [one(["<header>" + other() + "</header>", "<nav><ul>" + "".join(f"<li><a href=x>{other()[:20]}</a></li>" for _ in range(6)) + "</ul></nav>", aside()]) for _ in range(int(pick.integers(3)))]
    after = [one(["<footer>" + other() + "</footer>", aside()]) for _ in range(int(pick.integers(3)))]
    page = "".join(before) + body + "".join(after)
    new = Tree(one([f"<html><body>{page}</body></html>", page, f"<html><body><div>{page}</div></body></html>"]))
    label = np.array([t.startswith(SIGN) for t in new.text], dtype=np.float64)
    new.text = [t.removeprefix(SIGN) for t in new.text]
    for k in range(len(label) - 1, 0, -1):
        label[new.parent[k]] = max(label[new.parent[k]], label[k])
    return new, label


def in_context(tree: Tree, score: np.ndarray, siblings: float = 0.5, above: float = 0.6) -> np.ndarray:
    """Scores with a share of the mean of the siblings' and of the parent's."""
    parent = np.maximum(np.array(tree.parent), 0)
    n = len(score)
    mean = np.bincount(parent[1:], score[1:], n) / np.maximum(np.bincount(parent[1:], minlength=n), 1)
    out = score + siblings * np.clip(mean[parent], -4, 4)
    out[0] = 0.0
    for k in range(1, n):
        out[k] += above * min(max(out[parent[k]], -4.0), 4.0)
    return out


def decoded(tree: Tree, score: np.ndarray) -> str:
    """Text blocks of the connected top part of the tree with the greatest
    sum of scores; a page without block elements is all text."""
    n = len(tree.tag)
    if all(t == "#text" for t in tree.tag[1:]):
        return "\n".join(tree.text[1:])
    gain = in_context(tree, score)
    for k in range(n - 1, 0, -1):
        if gain[k] > 0:
            gain[tree.parent[k]] += gain[k]
    keep = np.zeros(n, dtype=bool)
    keep[0] = True
    for k in range(1, n):
        keep[k] = keep[tree.parent[k]] and gain[k] > 0
    return "\n".join(tree.text[k] for k in range(n) if keep[k] and tree.tag[k] == "#text")


def _plain_score(x: np.ndarray) -> np.ndarray:
    """Without a model: text outside of named side parts and links counts."""
    good = (x[:, 3] == 0) & (x[:, 5] == 0) & (x[:, 2] == 0) & (x[:, 19] < 0.5)
    return np.where(good, 1.0, -1.0)


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Boosted | None:
    """The node model, trained on at most about ``sample_pages`` of the pages
    with an article or main tag (by a range of a hash), of which each gives
    ``SAMPLE_NODES`` nodes at most. None if no page says where its article is."""
    hashed = pages.where(F.col("html").rlike(NAMES_ARTICLE)).select("html", F.xxhash64("html", "url").alias("h"))
    count = hashed.count()
    kept = hashed.where((F.col("h") / F.lit(2.0 ** 64) + 0.5) < F.lit(sample_pages / max(count, sample_pages)))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            got = []
            for h, html in zip(frame["h"], frame["html"]):
                tree = Tree(html)
                x = features(tree)
                y = said_labels(tree, x)
                if y is None:
                    continue
                new = [rebuilt(tree, y, (int(h) & 0xFFFFFFFF) + k) for k in range(REBUILDS)]
                for x, y in [(x, y), *((features(t), label) for t, label in filter(None, new))]:
                    some = np.unique(np.linspace(0, len(y) - 1, min(len(y), SAMPLE_NODES)).astype(int))
                    got.append((h, np.column_stack([x[some], y[some]]).astype(np.float32).ravel()))
            yield pd.DataFrame(got, columns=["h", "v"])

    found = kept.mapInPandas(rows, "h long, v array<float>").toPandas().sort_values("h", kind="stable")
    if not len(found):
        return None
    table = np.concatenate([np.asarray(v, dtype=np.float64) for v in found["v"]]).reshape(-1, FEATURES + 1)
    x, y = table[:, :-1], table[:, -1]
    blind = x.copy()
    blind[:, NAMED] = 0.0
    return Boosted().fit(np.concatenate([x, blind]), np.concatenate([y, y])) if 0 < y.mean() < 1 else None


def main_text(pages: DataFrame, html: Column, model: Boosted | None) -> Column:
    """Main text of each page; null and empty pages give the empty text."""
    held = pages.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = pickle.loads(held.value)
        for s in batches:
            out: list[str] = []
            trees: list[Tree] = []
            rows: list[np.ndarray] = []

            def done() -> None:
                if trees:
                    x = np.concatenate(rows)
                    score = own.score(x) if own else _plain_score(x)
                    at = 0
                    for t in trees:
                        out.append(decoded(t, score[at:at + len(t.tag)]))
                        at += len(t.tag)
                trees.clear()
                rows.clear()

            for h in s:
                trees.append(Tree(h or ""))
                rows.append(features(trees[-1]))
                if sum(map(len, rows)) > 20_000:
                    done()
            done()
            yield pd.Series(out, dtype=object)

    return extract(html)


def extracted(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points of the text).

    Blocks of the kept nodes in page order, joined by \\n; character
    references decoded, white space within a block one space. Every row is
    kept; broken markup is mended, a page without any gives its text or
    nothing. Repeated rows get the same text; other columns are not read."""
    model = fit(pages)
    return pages.select("page_id", "url", main_text(pages, F.col("html"), model).alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
