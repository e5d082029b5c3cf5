"""Main text of pages, spelling variants and hard negatives against plain-Python definitions."""

import html
import math
import random
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import mainblocks, negatives, queries, spelling

FOLDER = "/root/testdata/sf0.001"


# ------------------------------------------------------------------------------------------------------------ main text
@pytest.fixture(scope="module")
def tree(spark):
    return mainblocks.fit(spark)


def filler(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(["stone", "river", "slowly", "and", "the", "winter", "&amp;", "caf&eacute;", "x &lt; y"]) for _ in range(n))


def shown(s):
    return " ".join(html.unescape(s).split())


def layouts():
    """Pages of layouts that are not in the labelled table, with their main text."""
    a, b, c, d = filler(45, 1), filler(3, 2), filler(90, 3), filler(12, 4)
    text = "\n".join(map(shown, ("Title here", a, b, c)))
    yield (f"<html><body class='has-sidebar'><div class='top-bar nav'><a href='/'>Home</a><a href='/x'>News</a></div><main id=main><h1>Title here</h1>"
           f"<p>{a}</p><p>{b}<p>{c}</main><div class='cookie-banner'>{filler(30, 5)}</div><footer>{d}</footer></body></html>"), text
    yield (f"<header><nav><a href=1>A</a></nav><p>{d}</p></header><article><header><h1>Title here</h1></header><p>{a}</p><div class=advert>{d}</div>"
           f"<p>{b}</p>\n<p>{c}</p><section id=comments><h2>Comments</h2><p>{filler(50, 6)}</p></section></article><aside><p>{filler(40, 7)}</p></aside>"), text
    yield (f"<!-- a > b --><SCRIPT>if (a < b) document.write('<p>no</p>')</SCRIPT><style>p > a {{}}</style><noscript>{d}</noscript>"
           f"<div role=navigation><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><article data-x='a > b'><h1>Title here</h1><p>{a}<p>{b}<p>{c}"
           f"</article><form><label>{d}</label><textarea>{a}</textarea><select><option>{b}</select></form>"), text
    yield f"<p>{a}</p><p>{c}</p><ul><li><a href=a>{b}</a></li><li><a href=b>{b}</a></li></ul>", "\n".join(map(shown, (a, c)))
    yield f"<article><h1>Title here</h1><p>{a}<p>{b}<p>{c}", text  # cut off
    yield f"<article><p hidden>{a}</p><p>{c} <b>bold</b><br>next<!-- x --> li<i>n</i>e</p></article>", shown(c + " bold next line")
    yield f"<nav>{d}</nav><footer>{c}</footer>", ""


def test_layouts(tree):
    pages, wanted = zip(*layouts())
    assert mainblocks.main_texts(list(pages), tree) == list(wanted)


def test_tree_learns_its_table(tree):
    x, y = zip(*mainblocks.labelled_blocks())
    right = (tree.predict(np.array(x)) == np.array(y)).mean()
    assert right > 0.97 and len(y) > 100


class Article(HTMLParser):
    """The text of the article element by the standard parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        self.parts += [""] if tag in ("p", "h1") else []
        self.parts[-1] += " " if tag == "br" else ""

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        self.parts += [""] if tag in ("p", "h1") else []

    def handle_data(self, data):
        self.parts[-1] += data if self.inside else ""


def test_pages_against_standard_parser(spark):
    got = {r.page_id: r for r in queries.QUERIES["op11_html_extraction"](spark, FOLDER).collect()}
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        parser = Article()
        parser.feed(p.html)
        parser.close()
        assert got[p.page_id].text == "\n".join(" ".join(x.split()) for x in parser.parts if x.split())
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].url == p.url


def test_odd_pages(spark, tree):
    long = "<article>" + "<p>some words of a long page</p>" * 20000
    rows = [(1, None, "a"), (2, "", "b"), (3, "<", "c"), (4, "<p", "d"), (5, "<!--", None), (6, long, "e"), (6, long, "e"), (None, "<a href=", "f"),
            (7, "\x00 &#0; &bogus; &#x110000;", "g"), (8, "<" * 5000 + "'\"" * 5000, "h"), (9, "</p></div></article>" * 3000, "i")]
    df = spark.createDataFrame(rows, "page_id int, html string, main_text string")
    out = mainblocks.extract(df, tree=tree).collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"page_id", "main_text"}
    by = {r.page_id: r.main_text for r in out}
    assert by[1] == by[2] == by[4] == by[5] == by[9] == "" and len(by[6].split("\n")) == 20000
    assert mainblocks.extract(df.limit(0), tree=tree).count() == 0


# ------------------------------------------------------------------------------------------------------ spelling variants
def brute_variants(rows):
    seen = Counter()
    for id_, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            seen[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in seen.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if a == b or len(b) - len(a) > 1:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]

    out, form = {}, {}
    for w in n:
        close = [x for x in n if near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
        out[w] = [form[w], w, n[w], len(close), n[form[w]] if form[w] else None]
    for w in n:
        while form[out[w][1]]:
            out[w][1] = form[out[w][1]]
    return {w: tuple(v) for w, v in out.items()}


def as_rows(df):
    rows = df.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def variant_texts():
    r = random.Random(5)
    syllables = ["an", "be", "ce", "é", "ta", "ri", "a", "ÿo", "ß", "na"]
    base = ["".join(r.choice(syllables) for _ in range(r.randint(4, 9))) for _ in range(60)]
    words = []
    for w in base:
        words += [w] * r.choice([2, 3, 30, 400])
        for _ in range(4):
            i = r.randrange(len(w))
            v = r.choice([w[:i] + w[i + 1:], w[:i] + "x" + w[i:], w[:i] + "z" + w[i + 1:], w + "s", "q" + w, w[:-1]])
            words += [v] * r.choice([2, 2, 5, 40])
    words += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa"] * 2 + ["b" * 5000, "b" * 5001] * 3 + ["RIVERSIDE", "Riverside", "riverſide", "ÀÉÎÕÜàé", "ÀÉÎÕÜàé"]
    r.shuffle(words)
    return [(k, " ".join(words[i:i + 50]) + ".") for k, i in enumerate(range(0, len(words), 50))]


def test_variants_against_brute_force(spark):
    rows = variant_texts() + [(None, "fountains fountains"), (None, None), (7, ""), (8, "... 123 ×÷××÷×÷ ×÷××÷×÷")]
    rows += rows[:3]
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, n int, word string, form string")
    want = brute_variants(rows)
    assert as_rows(spelling.variants(df)) == want
    assert sum(v[3] > 0 for v in want.values()) > 100 and any(v[0] and v[1] != v[0] for v in want.values())


def test_variants_of_nothing(spark, no_docs):
    assert spelling.variants(no_docs).count() == 0
    one = spark.createDataFrame([(1, "lonesome lonesome other")], "doc_id long, text string")
    assert as_rows(spelling.variants(one)) == brute_variants([(1, "lonesome lonesome other")])


# --------------------------------------------------------------------------------------------------------- hard negatives
def brute_negatives(rows):
    good = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows
            if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    anchors = {}
    for i, lab, v in good:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (lab, v)), (lab, v))
    out = []
    for i, (lab, v) in anchors.items():
        scores = sorted((-dot(v, x), j, m == lab) for j, m, x in good)
        for s, j, _ in [t for t in scores if t[2] and t[1] != i][:5]:
            fit = [(k, -t) for t, k, same in scores if not same and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(i, j, r + 1, k, -s, t) for r, (k, t) in enumerate(fit)]
    return Counter(out)


def vectors(n, dims, seed):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(6, dims))
    return [[float(np.float32(x)) for x in centre[k % 6] * 0.3 + r.normal(size=dims) * 0.2] for k in range(n)]


@pytest.mark.parametrize("cells,anchors", [(1 << 22, 16384), (400, 3)])
def test_negatives_against_brute_force(spark, monkeypatch, cells, anchors):
    monkeypatch.setattr(negatives, "SHARD_CELLS", cells)
    monkeypatch.setattr(negatives, "GROUP_ANCHORS", anchors)
    monkeypatch.setattr(negatives, "BLOCK", 16)
    v = vectors(260, 8, 3)
    rows = [(i * 20 if i % 3 else i * 50, v[i if i % 4 else 0], i % 4) for i in range(260)]  # a quarter of the rows hold one vector
    rows += [rows[5], rows[5], (0, v[9], 1), (None, v[1], 1), (300, None, 1), (400, v[1], None), (500, [float("nan")] * 8, 1), (600, [None] * 8, 1),
             (700, [float("inf")] + [0.0] * 7, 1), (800, [0.0] * 8, 2), (900, [], 2), (1000, v[3][:5], 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, shard string, rank int")
    got = Counter(tuple(r) for r in negatives.hard_negatives(df).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == brute_negatives(rows) and len(got) > 100


def test_walk_ends_early():
    """Tight clusters end long before the list does, and still return the best."""
    r = np.random.default_rng(1)
    x = np.floor(256 * (np.repeat(np.eye(8), 500, 0) + r.normal(size=(4000, 8)) * 0.02))
    shard = {"x": x, "id": np.arange(4000), "label": np.arange(4000) % 2, "length": negatives._length(x)}
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, k):
            read.append(np.size(k))
            return np.asarray(super().__getitem__(k))

    group = {"x": x[:5], "id": np.arange(5) + 10000, "label": np.zeros(5, int), "cluster": np.zeros(5, int), "of": np.arange(5),
             "low": np.full(5, -10**9), "high": np.full(5, 10**9)}
    slot, score, ids = negatives.walk(group, shard, True, 5)
    for k in range(5):
        s = (x @ x[k])[::2]
        assert sorted(score[slot == k], reverse=True) == sorted(s, reverse=True)[:5]
    shard["label"] = shard["label"].view(Counted)
    negatives.walk(group, shard, True, 5)
    assert sum(read) <= 1024


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(df).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 3)], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(one).count() == 0
    huge = spark.createDataFrame([(i * 50, [1e6 * (i + 1), -2e5], i % 2) for i in range(8)], "vec_id long, embedding array<double>, label int")
    rows = [(r.vec_id, r.embedding, r.label) for r in huge.collect()]
    assert Counter(tuple(r) for r in negatives.hard_negatives(huge).collect()) == brute_negatives(rows)
