"""Operator 3: main text of web pages by boosted trees over DOM nodes.

A page is read into its tree of nodes (blocks, and inline elements that carry a
class, id or role).  Every node gets features of its subtree (text and link
density, kinds of tags), its attribute tokens and those of its ancestors, its
depth and its siblings.  Gradient-boosted trees give each node the log-odds
that its subtree holds main text.  A label "no" of a node is a "no" for all
below it, so the labels are decoded over the whole tree: a node stays where its
own log-odds and the best labels of its children add up to a gain.  The kept
text keeps page order.

The trees are trained when the operator is called, on ``TRAIN_PAGES`` pages
that ``labelled_page`` lays out in many ways with known main text: tables of
pages come without such labels, and the features look at form, never at words.

Cases: null html is empty; a page without main text has the empty text; broken
markup is read as far as it goes (open elements end with their parents); null
urls and ids pass through; repeated rows are all returned; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import text_parts

TRAIN_PAGES = 700
TREES, DEPTH, RATE, BINS = 40, 4, 0.3, 32

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>"""
                 r"""|<([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
END_OF = {t: re.compile(rf"</{t}\b", re.I) for t in ("script", "style", "title", "textarea", "noscript",
                                                     "template", "iframe", "svg")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""html body address article aside blockquote center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary
    table tbody td tfoot th thead tr ul select option button label""".split())
#: Elements that a start tag ends, and those that it does not look beyond.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
CONTROLS = frozenset("input select textarea button label option".split())

#: Families of tags and of attribute tokens (stems) that features name.
TAGS = [{"article"}, {"main"}, {"section"}, {"div", "center"}, {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"},
        {"ul", "ol", "dl", "menu"}, {"li", "dt", "dd"}, {"nav"}, {"header"}, {"footer"}, {"aside"},
        {"form", "fieldset", *CONTROLS}, {"table", "tbody", "tr", "td", "th"},
        {"figure", "figcaption", "blockquote", "pre"}, {"body", "html"}]
TOKENS = [
    ["article", "content", "main", "post", "entry", "story", "body", "text", "prose", "hentry"],
    ["nav", "menu", "breadcrumb", "toc", "tabs", "pagination", "pager", "links", "skip"],
    ["header", "masthead", "topbar", "logo", "brand", "head"],
    ["footer", "foot", "copyright", "legal", "colophon", "bottom"],
    ["sidebar", "side", "aside", "widget", "rail", "related", "recommended", "popular", "trending", "more", "tags"],
    ["ad", "ads", "advert", "advertisement", "adsense", "banner", "promo", "promoted", "sponsor", "sponsored"],
    ["cookie", "consent", "notice", "alert", "popup", "modal", "gdpr", "warning", "overlay", "toast", "paywall"],
    ["comment", "comments", "reply", "replies", "disqus", "respond", "discussion", "reader", "readers", "feedback"],
    ["form", "login", "signup", "subscribe", "newsletter", "search", "register", "contact"],
    ["share", "social", "follow", "like", "print", "tools", "buttons", "toolbar"],
]
TAG_FAMILY = {t: i for i, ts in enumerate(TAGS) for t in ts}
TOKEN_FAMILY = {w: i for i, ws in enumerate(TOKENS) for w in ws}
ROOT, N_TAG, N_TOKEN = 0, len(TAGS), len(TOKENS)


class Page:
    """Nodes of one page in page order; node 0 is the page itself."""

    __slots__ = ("parent", "depth", "tag", "tokens", "items", "links", "controls", "marks", "node_at")

    def __init__(self, source: str):
        self.parent, self.depth, self.tag, self.tokens = [0], [0], [""], [0]
        self.items: list[tuple[int, int, str, bool]] = []  # node, block, text, in a link
        self.links, self.controls, self.marks = [0], [0], []
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("", ROOT)]  # open elements and their nodes
        block, in_link, pos, n = 0, 0, 0, len(source)
        parent, depth, tags, tokens, items = self.parent, self.depth, self.tag, self.tokens, self.items
        search = TAG.search
        while pos < n:
            m = search(source, pos)
            end = m.start() if m else n
            if end > pos:
                text = source[pos:end]
                if "&" in text:
                    text = entities.unescape(text)
                items.append((stack[-1][1], block, text, in_link > 0))
            if not m:
                break
            pos = m.end()
            name = m[2] or m[4]
            if name:
                name = name.lower()
                if name in END_OF:
                    raw = m[3] if m[2] else m[5]
                    if not raw.rstrip().endswith("/") or name != "svg":
                        e = END_OF[name].search(source, pos)
                        at = e.start() if e else n
                        close = source.find(">", at)
                        pos = close + 1 if e and close >= 0 else n
                    if name == "textarea":
                        self.controls[stack[-1][1]] += 1
                    continue
                is_block = name in BLOCK
                if is_block:
                    block += 1
                    ends, scope = CLOSES.get(name, ({"p"}, {"td", "th", "button", "table"}))
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] in scope:
                            break
                        if stack[k][0] in ends:
                            in_link -= sum(t == "a" for t, _ in stack[k:])
                            del stack[k:]
                            break
                node = stack[-1][1]
                if name == "a":
                    self.links[node] += 1
                elif name in CONTROLS:
                    self.controls[node] += 1
                if name in VOID:
                    if name == "br":
                        items.append((node, block, " ", False))
                    continue
                raw = m[3] if m[2] else m[5]
                family = 0
                if raw and "=" in raw:
                    for v in ATTRIBUTE.findall(raw):
                        for w in WORD.findall(v):
                            f = TOKEN_FAMILY.get(w.lower())
                            if f is not None:
                                family |= 1 << f
                if is_block or family:
                    parent.append(node)
                    depth.append(depth[node] + 1)
                    tags.append(name)
                    tokens.append(family)
                    self.links.append(0)
                    self.controls.append(0)
                    node = len(parent) - 1
                in_link += name == "a"
                stack.append((name, node))
            elif m[1]:
                name = m[1].lower()
                if name in BLOCK:
                    block += 1
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        in_link -= sum(t == "a" for t, _ in stack[k:])
                        del stack[k:]
                        break
                    if name not in BLOCK and stack[k][0] in BLOCK:
                        break  # an inline end does not end a block

    def text(self, keep: np.ndarray) -> str:
        """Text of the kept nodes, a block to a line."""
        out, last, held = [], None, []
        for node, block, text, _ in self.items:
            if keep[node]:
                if block != last and held:
                    out.append(" ".join("".join(held).split()))
                    held = []
                last = block
                held.append(text)
        out.append(" ".join("".join(held).split()))
        return "\n".join(x for x in out if x)


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, parents and depths of all nodes of the pages, one after the other."""
    sizes = np.array([len(p.parent) for p in pages])
    first = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    parent = np.concatenate([np.array(p.parent) + f for p, f in zip(pages, first)])
    depth = np.concatenate([np.array(p.depth) for p in pages])
    page = np.repeat(np.arange(len(pages)), sizes)
    tag = np.array([TAG_FAMILY.get(t, N_TAG) for p in pages for t in p.tag])
    tokens = np.concatenate([np.array(p.tokens) for p in pages])
    own = np.zeros((total, 7))  # text, words, marks, link text, links, controls, nodes
    node = np.array([f + i[0] for p, f in zip(pages, first) for i in p.items], np.int64)
    stripped = [(i[2].strip(), i[3]) for p in pages for i in p.items]
    counts = np.array([(len(t), t.count(" ") + bool(t), sum(map(t.count, ".,;!?")), len(t) * a)
                       for t, a in stripped], np.float64).reshape(-1, 4)
    for k in range(4):
        own[:, k] = np.bincount(node, counts[:, k], total) if len(node) else 0
    own[:, 4] = np.concatenate([np.array(p.links) for p in pages])
    own[:, 5] = np.concatenate([np.array(p.controls) for p in pages])
    own[:, 6] = 1
    is_p = (tag == TAG_FAMILY["p"]).astype(float)
    is_li = (tag == TAG_FAMILY["li"]).astype(float)
    sums = np.concatenate([own, is_p[:, None], is_li[:, None]], axis=1)
    child = parent != np.arange(total)
    # subtree sums upwards, what ancestors are downwards, one depth at a time
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(depth.max() + 2))
    for d in range(int(depth.max()), 0, -1):
        at = order[cuts[d]:cuts[d + 1]]
        np.add.at(sums, parent[at], sums[at])
    above_tokens, above_tags = np.zeros(total, np.int64), np.zeros(total, np.int64)
    for d in range(1, int(depth.max()) + 1):
        at = order[cuts[d]:cuts[d + 1]]
        up = parent[at]
        above_tokens[at] = above_tokens[up] | tokens[up]
        above_tags[at] = above_tags[up] | 1 << tag[up]
    text = sums[:, 0]
    kids = np.bincount(parent[child], minlength=total)
    number = np.zeros(total)  # place among the siblings
    by_parent = np.argsort(parent, kind="stable")
    starts = np.r_[True, parent[by_parent][1:] != parent[by_parent][:-1]]
    run = np.arange(total) - np.maximum.accumulate(np.where(starts, np.arange(total), 0))
    number[by_parent] = run
    sibling_text = np.bincount(parent[child], text[child], total)
    same = np.unique(parent * (N_TAG + 1) + tag, return_inverse=True)[1]
    alike = np.bincount(same)[same]
    n_sib = np.maximum(kids[parent], 1)
    page_text = np.maximum(text[first][page], 1)
    some = np.maximum(text, 1)
    x = [np.log1p(text), np.log1p(own[:, 0]), sums[:, 3] / some, 100 * sums[:, 6] / (some + 100),
         depth, n_sib, number / n_sib, alike / n_sib, text / page_text,
         text / np.maximum(sibling_text[parent] / n_sib, 1), sums[:, 2] / np.maximum(sums[:, 1], 1),
         sums[:, 0] / np.maximum(sums[:, 1], 1), np.log1p(sums[:, 7]), sums[:, 8] / sums[:, 6],
         np.log1p(sums[:, 4]), np.log1p(sums[:, 5]), sums[:, 1] / sums[:, 6]]
    x += [(tag == k).astype(float) for k in range(N_TAG)]
    x += [(tokens >> k & 1).astype(float) for k in range(N_TOKEN)]
    x += [(above_tokens >> k & 1).astype(float) for k in range(N_TOKEN)]
    x += [(above_tags >> k & 1).astype(float) for k in range(N_TAG)]
    return np.stack(x, axis=1).astype(np.float32), parent, depth


@dataclass
class Trees:
    """Boosted trees of one depth over binned features."""

    edges: list[np.ndarray]
    start: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, leaves)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(self.edges)], 1).astype(np.uint8)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        rows, out = np.arange(len(b)), np.full(len(b), self.start)
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(b), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (b[rows, feature[at]] > threshold[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, rate: float = RATE) -> Trees:
    """Newton boosting of the logistic loss on histograms."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    model = Trees(edges, float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), *(np.zeros((0, 0)),) * 3)
    b = model.binned(x).astype(np.int64)
    n, width = b.shape
    f, inner = np.full(n, model.start), 2**DEPTH - 1
    features_, thresholds_, leaves_ = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        grad, hess = y - p, p * (1 - p)
        feature, threshold, at = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64), np.zeros(n, np.int64)
        for level in range(DEPTH):
            base, count = 2**level - 1, 2**level
            key = ((at - base)[:, None] * width + np.arange(width)) * BINS + b
            size = count * width * BINS
            g = np.bincount(key.ravel(), np.repeat(grad, width), size).reshape(count, width, BINS).cumsum(2)
            h = np.bincount(key.ravel(), np.repeat(hess, width), size).reshape(count, width, BINS).cumsum(2)
            gs, hs = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + 1) + (gs - g)**2 / (hs - h + 1) - gs**2 / (hs + 1)
            gain[(h < 2) | (hs - h < 2)] = -1
            best = gain.reshape(count, -1).argmax(axis=1)
            good = gain.reshape(count, -1)[np.arange(count), best] > 1e-6
            feature[base:base + count] = best // BINS
            threshold[base:base + count] = np.where(good, best % BINS, BINS)
            at = 2 * at + 1 + (b[np.arange(n), feature[at]] > threshold[at])
        leaf_of = at - inner
        value = rate * np.bincount(leaf_of, grad, inner + 1) / (np.bincount(leaf_of, hess, inner + 1) + 1)
        f += value[leaf_of]
        features_.append(feature)
        thresholds_.append(threshold)
        leaves_.append(value)
    model.feature, model.threshold, model.leaf = map(np.array, (features_, thresholds_, leaves_))
    return model


def decode(log_odds: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Kept nodes: the best labels in which no node below a dropped one is kept; the pages' roots stay."""
    gain = np.clip(log_odds, -6, 6)
    root = parent == np.arange(len(parent))
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(depth.max() + 2))
    for d in range(int(depth.max()), 0, -1):
        at = order[cuts[d]:cuts[d + 1]]
        np.add.at(gain, parent[at], np.maximum(gain[at], 0))
    keep = root | (gain > 0)
    for d in range(1, int(depth.max()) + 1):
        at = order[cuts[d]:cuts[d + 1]]
        keep[at] &= keep[parent[at]]
    return keep


def main_texts(sources: list[str], model: Trees) -> list[str]:
    """Main text of every page."""
    if not sources:
        return []
    pages = [Page(s) for s in sources]
    x, parent, depth = features(pages)
    keep = decode(model.log_odds(x), parent, depth)
    ends = np.cumsum([len(p.parent) for p in pages])
    return [p.text(k) for p, k in zip(pages, np.split(keep, ends[:-1]))]


# -- pages to learn from

MARK = "\x01"  # begins every piece of main text of a labelled page


def labelled_page(rng: random.Random) -> str:
    """A page laid out at random; its main text carries ``MARK``."""
    pick, chance = rng.choice, lambda p: rng.random() < p

    def words(low, high):
        n = rng.randint(low, high)
        s = " ".join("".join(pick("aeiounrtsl") for _ in range(rng.randint(1, 9))) for _ in range(n))
        return s.capitalize() + pick(["", ".", ".", ", and so.", "!"])

    def attrs(*names):
        name = pick(names)
        if chance(0.2):
            name = pick(["c", "js", "m", "u"]) + "-" + name
        if chance(0.2):
            name += pick([" wide", "-box", "__inner", "-1", " row", "Wrap"])
        return f' {pick(["class", "class", "id"])}="{name}"'

    def el(tag, inner, attributes=""):
        return f"<{tag}{attributes}>{inner}</{tag}>" + pick(["", "", "\n"])

    def link():
        return f'<a href="/{words(1, 1)}">{words(1, 4)}</a>'

    def links(low=3, high=9):
        items = "".join(el("li", link()) for _ in range(rng.randint(low, high)))
        return el(pick(["ul", "ul", "ol"]), items) if chance(0.8) else " | ".join(link() for _ in range(rng.randint(low, high)))

    def junk_text():
        return pick([lambda: words(2, 12), lambda: el("p", words(3, 40)), lambda: el("div", words(2, 25)),
                     lambda: el("h3", words(1, 4)) + links(2, 6), lambda: el("p", words(3, 12)) + el("p", words(3, 30))])()

    def nav():
        return el("nav", links(), attrs("nav", "menu") if chance(0.3) else "") if chance(0.6) else el(
            "div", links(), attrs("nav", "menu", "navbar nav", "breadcrumb", "main-menu", "top-nav", "tabs"))

    def ad():
        tag = pick(["div", "div", "div", "aside", "section", "p"])
        return el(tag, words(2, 30) if chance(0.6) or tag == "p" else junk_text(), attrs(
            "ad", "ads", "advert", "advertisement", "banner", "promo", "sponsored", "sponsor", "ad-slot", "cookie",
            "cookie-notice", "notice", "alert", "consent", "popup", "modal", "gdpr"))

    def header():
        inner = el(pick(["h1", "h2", "div", "p", "a"]), words(1, 5)) + (nav() if chance(0.5) else junk_text())
        return el("header", inner) if chance(0.6) else el("div", inner, attrs("header", "masthead", "topbar", "page-header", "logo"))

    def footer():
        inner = pick([lambda: "&copy; " + words(2, 20), lambda: el("p", "&copy; " + words(2, 30)),
                      lambda: links() + el("p", words(3, 20)), lambda: words(3, 30) + " &middot; " + link(),
                      lambda: el("div", junk_text()) + el("p", words(2, 15))])()
        return el("footer", inner) if chance(0.65) else el("div", inner, attrs("footer", "foot", "site-footer", "copyright", "legal", "bottom"))

    def aside():
        inner = "".join(pick([lambda: el("h3", words(1, 4)) + links(), junk_text, lambda: el("div", words(3, 30), attrs("widget", "box"))])()
                        for _ in range(rng.randint(1, 3)))
        return el("aside", inner) if chance(0.5) else el("div", inner, attrs("sidebar", "side", "widget", "rail", "related", "popular", "recommended"))

    def form():
        inner = el("label", words(1, 3)) + '<input type="text" name="q">' + el("button", words(1, 2))
        return el("form", inner + (el("p", words(3, 15)) if chance(0.4) else ""), attrs("search", "subscribe", "newsletter", "login", "contact") if chance(0.5) else "")

    def comments():
        one = lambda: el(pick(["div", "li", "article", "p"]), pick([lambda: words(3, 40), lambda: el("p", words(3, 60)), lambda: el("b", words(1, 2)) + el("p", words(4, 50))])(),
                         attrs("comment", "reply") if chance(0.7) else "")
        inner = (el("h3", words(1, 3)) if chance(0.6) else "") + "".join(one() for _ in range(rng.randint(1, 6)))
        return el(pick(["section", "div", "ol"]), inner + (form() if chance(0.3) else ""), attrs("comments", "comment-list", "discussion", "replies", "disqus", "readers"))

    def share():
        return el("div", links(2, 5) if chance(0.7) else words(1, 8), attrs("share", "social", "related", "follow", "tags", "toolbar", "more"))

    def good(low, high):
        return MARK + words(low, high)

    def paragraph():
        low, high = pick([(1, 3), (4, 15), (10, 60), (30, 150)])
        kind = rng.random()
        if kind < 0.12:
            return f"<p><b>{good(low, high)}<br>"
        if kind < 0.2:
            return el("p", good(low, high) + " " + link() + " " + words(1, 10))
        if kind < 0.25:
            return el("p", good(low, high) + el("em", words(1, 4)) + words(1, 20))
        return el("p", good(low, high))

    def more():
        return pick([lambda: el(pick(["h2", "h3"]), good(1, 8)), lambda: el("ul", "".join(el("li", good(2, 25)) for _ in range(rng.randint(2, 6)))),
                     lambda: el("blockquote", el("p", good(4, 40)) if chance(0.5) else good(4, 40)), lambda: el("pre", good(3, 30)),
                     lambda: el("table", "".join(el("tr", "".join(el("td", good(1, 4)) for _ in range(3))) for _ in range(rng.randint(1, 4)))),
                     lambda: el("figure", '<img src="a.png">' + el("figcaption", good(2, 15))), lambda: el("div", good(5, 80)),
                     lambda: el("section", el("h2", good(1, 6)) + paragraph() + paragraph())])()

    def article():
        body = []
        for _ in range(pick([0, 1, 2, 4, 8, 14, 25])):
            body.append(paragraph() if chance(0.8) else more())
            if chance(0.05):
                body.append(pick([ad, share, form])())
        if chance(0.12):  # text without paragraphs
            body = [good(10, 200) + "<br><br>" + words(10, 100)]
        title = el("h1", good(1, 12)) if chance(0.8) or not body else ""
        if title and chance(0.15):
            title = el("header", title)
        inner = title + "".join(body)
        if chance(0.25):
            inner = title + el("div", "".join(body) or good(2, 9), attrs("content", "body", "text", "entry-content", "article-body") if chance(0.7) else "")
        if chance(0.15):
            inner += pick([share, comments, ad, aside])()
        if chance(0.5):
            return el("article", inner, attrs("post", "entry", "story") if chance(0.2) else "")
        return el(pick(["div", "div", "section", "main"]), inner,
                  attrs("article", "post", "entry", "story", "content", "main", "article-body", "text") if chance(0.75) else "")

    before = "".join(pick([nav, ad, header, form])() for _ in range(rng.randint(0, 4)))
    after = "".join(pick([ad, aside, comments, share, form])() for _ in range(rng.randint(0, 3)))
    after += footer() if chance(0.85) else ""
    middle = article()
    if chance(0.3):
        middle = el(pick(["main", "div", "section"]), middle + (after if chance(0.3) else ""), attrs("main", "content", "container", "layout", "page") if chance(0.7) else "")
    if chance(0.3):
        side = aside()
        middle = side + middle if chance(0.5) else middle + side
    inner = before + middle + after
    if chance(0.3):
        inner = el("div", inner, attrs("page", "wrapper", "container", "site"))
    return (f"<!DOCTYPE html><html><head><title>{words(2, 9)}</title><style>p{{margin:0}}</style></head><body>"
            f"<script>var a=\"</p>\";</script>{inner}</body></html>")


def train(pages: int = TRAIN_PAGES, seed: int = 11) -> Trees:
    """Trees from ``pages`` labelled pages: a node's label is whether its subtree holds main text."""
    rng = random.Random(seed)
    read, labels = [], []
    for _ in range(pages):
        page = Page(labelled_page(rng))
        y = np.zeros(len(page.parent))
        for node, _, text, _ in page.items:
            if MARK in text:
                y[node] = 1
        for k in range(len(y) - 1, 0, -1):
            y[page.parent[k]] = max(y[page.parent[k]], y[k])
        page.items = [(a, b, t.replace(MARK, ""), c) for a, b, t, c in page.items]
        read.append(page)
        labels.append(y)
    return boost(features(read)[0], np.concatenate(labels))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, ``text``, ``n_chars`` of every row."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(train())  # bounded by TREES and DEPTH

    @pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in text_parts(batches):
            yield pd.Series(main_texts(part, shared.value), dtype=object)

    return pages.select("page_id", "url", of("html").alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long"))
