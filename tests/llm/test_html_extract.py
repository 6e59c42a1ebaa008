import random
from collections import Counter

import numpy as np
import pytest

from addrlink.llm import html_extract as h


@pytest.fixture(scope="module")
def model():
    return h.train()


def test_pages_held_out_from_training(model):
    rng = random.Random(77)
    marked = [h.labelled_page(rng) for _ in range(150)]
    got = h.main_texts([m.replace(h.MARK, "") for m in marked], model)
    same = found = wanted = 0
    for m, text in zip(marked, got):
        page = h.Page(m)
        keep = np.zeros(len(page.parent), bool)
        for node, _, t, _ in page.items:
            keep[node] |= h.MARK in t
        a, b = Counter(page.text(keep).replace(h.MARK, "").split()), Counter(text.split())
        same += sum((a & b).values())
        wanted += sum(a.values())
        found += sum(b.values())
    assert same / wanted > 0.98 and same / found > 0.98


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><div class="ad">Buy it now.</div>
<article><h1>Head &amp; line</h1><p><b>First  paragraph with some words,\n and more of them.<br><p>Second &lt;one&gt; of
the page, long enough to be a text.</p><script>var t="</p>";</script><p>Third.</p></article>
<div class="comments"><p>I like this page a lot.</p></div><footer>&copy; me &middot; words</footer></body></html>"""


def test_one_page(model):
    assert h.main_texts([PAGE], model) == [
        "Head & line\nFirst paragraph with some words, and more of them.\n"
        "Second <one> of the page, long enough to be a text.\nThird."]


def test_no_page_depends_on_its_batch(model):
    rng = random.Random(5)
    pages = [h.labelled_page(rng).replace(h.MARK, "") for _ in range(20)] + ["", "text only", PAGE]
    assert h.main_texts(pages, model) == [h.main_texts([p], model)[0] for p in pages]


def test_labels_never_contradict():
    rng = np.random.default_rng(0)
    n = 400
    parent = np.r_[0, [rng.integers(0, k) for k in range(1, n)]]
    depth = np.zeros(n, int)
    for k in range(1, n):
        depth[k] = depth[parent[k]] + 1
    odds = rng.standard_normal(n) * 3
    keep = h.decode(odds, parent, depth)
    assert all(keep[parent[k]] or not keep[k] for k in range(n))

    def best(k):  # the best sum over labels that keep k
        return odds[k].clip(-6, 6) + sum(max(best(j), 0) for j in range(1, n) if parent[j] == k)

    roots = [k for k in range(1, n) if parent[k] == 0]
    assert odds[keep & (depth > 0)].clip(-6, 6).sum() == pytest.approx(sum(max(best(k), 0) for k in roots))


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    odd = [None, "", "<", "<p", "a < b & c", "<!-- never closed", "<script>never closed", '<p class="x>y', "</p></div>",
           "<a><b><a></a></i></b>" * 50, deep, "<title>only", "\x00&#0;&#x110000;&bogus;", "<p>" + "word " * 50_000]
    pages = spark.createDataFrame([(i, None if i % 2 else "u", x, "text") for i, x in enumerate(odd)] + [(0, "u", None, "x")],
                                  "page_id long, url string, html string, text string")
    rows = h.extract(pages).collect()
    assert len(rows) == len(odd) + 1
    by_id = {r["page_id"]: r for r in rows}
    for i in (0, 1, 5, 6, 8, 11):
        assert by_id[i]["text"] == "" and by_id[i]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert by_id[13]["n_chars"] == 5 * 50_000 - 1
    assert h.extract(pages.where("page_id < 0")).count() == 0
