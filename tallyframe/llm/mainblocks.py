"""Main text of web pages: flat text blocks, judged by a decision tree over their own and their neighbours' figures.

A page is cut into blocks at block-level tags, whatever the nesting. A block's figures are its words and the share of them
inside links, the same of the block before and after, and marks its surroundings carry (inside an article, inside navigation,
a form, a container named like a notice or an advert). The tree is Spark ML's, fitted on ``LABELLED``, a small table of
pages in outline; a page's blocks never leave the task that reads it, so nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Comment, tag, or any other run that starts like markup; attributes may hold ">" in quotes.
MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
#: Elements whose content is no text of the page, and those whose content is read up to their own end tag.
DROPPED = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "noembed", "noframes", "xmp", "svg", "math", "select", "button", "canvas",
           "audio", "video", "object", "datalist"}
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3
h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul""".split())
#: Elements whose surroundings are looked at; the others only cut blocks.
HOLDERS = set("""article aside body dd details dialog div dl dt fieldset figure footer form header head html li main menu nav ol section table tbody td th tr ul
search p h1 h2 h3 h4 h5 h6""".split())
CLOSED_BY_BLOCK = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
ALIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
#: Container names, split at anything but letters; the first set speaks against main text, the second for it.
AGAINST = set("""ad ads adv advert adverts advertisement advertising adsense alert banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie
cookies copyright disclaimer discussion disqus dropdown feedback footer gdpr header hidden legal login masthead menu modal nav navbar navigation newsletter notice
notification pager pagination paywall popup promo promoted promotion rail recommended related replies reply respond responses search share sharing sidebar signup
skip social sponsor sponsored subscribe subscription taboola outbrain tags teaser toolbar topbar tracking trending warning widget widgets""".split())
FOR = set("article articlebody content entry main maintext post postbody story storybody text body".split())
ROLES_AGAINST = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "status"}
AGAINST_TAGS = {"nav", "footer", "aside", "dialog", "menu", "search"}

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "in_main", "page_has_main", "against", "heading", "item"]


class Block(NamedTuple):
    text: str
    linked: int
    in_main: int
    against: int
    heading: int
    item: int


class _Holder(NamedTuple):
    tag: str
    main: int
    against: int
    hidden: bool


def _marks(tag: str, attributes: str, up: _Holder) -> _Holder:
    main, against, hidden = up.main, up.against, up.hidden
    if tag in ("html", "body", "head"):
        return _Holder(tag, main, against, hidden)
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
    names = set(re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", f"{found.get('class', '')} {found.get('id', '')}").lower()))
    role = found.get("role", "").lower()
    style = found.get("style", "").replace(" ", "").lower()
    hidden = hidden or "hidden" in found or "display:none" in style or "visibility:hidden" in style or found.get("aria-hidden", "").lower() == "true"
    bad = bool(names & AGAINST) or role in ROLES_AGAINST
    if tag in AGAINST_TAGS or (tag == "header" and not main):
        against = 2
    elif tag in ("article", "main") or role in ("main", "article") or found.get("itemprop", "").lower() == "articlebody":
        if bad and tag != "main":
            against = max(against, 1)
        else:
            main, against = 1, 0 if against < 2 else against
    elif tag == "form":
        against = max(against, 1)
    elif bad:
        against = max(against, 1)
    elif names & FOR and not against:
        main = 1
    return _Holder(tag, main, against, hidden)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; a page without markup is one block, one without text has none."""
    out: list[Block] = []
    stack = [_Holder("", 0, 0, False)]
    pieces: list[str] = []
    linked, in_link, link_from = 0, False, 0
    heading = item = False

    def words_since(k: int) -> int:
        return len(html.unescape("".join(pieces[k:])).split())

    def flush() -> None:
        nonlocal linked, link_from
        if in_link:
            linked += words_since(link_from)
        text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
        pieces.clear()
        if text and not stack[-1].hidden:
            out.append(Block(text, linked, stack[-1].main, stack[-1].against, int(heading), int(item or any(h.tag == "li" for h in stack[-3:]))))
        linked, link_from = 0, 0

    at = 0
    n = len(page)
    while at < n:
        m = MARKUP.search(page, at)
        if m is None:
            pieces.append(page[at:])
            break
        if m.start() > at:
            pieces.append(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        if tag in DROPPED:
            if not closing and not m[0].endswith("/>"):
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I).search(page, at)
                at = end.end() if end else n
                pieces.append(" ")
            continue
        if tag == "a":
            if in_link:
                linked += words_since(link_from)
            in_link = not closing and "href" in (m[3] or m[0]).lower()
            link_from = len(pieces)
            continue
        if tag in ("br", "wbr"):
            pieces.append(" " if tag == "br" else "")
            continue
        if tag not in BLOCKS:
            continue
        flush()
        if closing:
            in_link = False
        heading = tag[0] == "h" and tag[1:].isdigit() and not closing
        item = tag in ("li", "dt", "dd") and not closing
        if tag not in HOLDERS:
            continue
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
        else:
            while len(stack) > 1 and (stack[-1].tag in CLOSED_BY_BLOCK or stack[-1].tag in ALIKE.get(tag, ())):
                stack.pop()
            stack.append(_marks(tag, m[3] or "", stack[-1]))
    flush()
    return out


def figures(found: list[Block]) -> np.ndarray:
    """One row of FEATURES per block of one page; neighbours that are not there count as no words."""
    words = np.array([len(b.text.split()) for b in found], float)
    links = np.array([b.linked for b in found], float) / np.maximum(words, 1)
    has_main = float(any(b.in_main and not b.against for b in found))
    side = lambda x, k: np.r_[np.zeros(1), x[:-1]] if k < 0 else np.r_[x[1:], np.zeros(1)]
    return np.column_stack([words, links, side(words, -1), side(links, -1), side(words, 1), side(links, 1), [b.in_main for b in found],
                            np.full(len(found), has_main), [b.against for b in found], [b.heading for b in found], [b.item for b in found]])


#: Labelled pages in outline. A number is a text of so many words, "+" marks main text; the rest is written as in a page.
LABELLED = """
<nav><ul><li><a href=x>1</a><li><a href=x>2</a><li><a href=x>1</a></ul></nav><div class=ad>8</div><article><h1>+9</h1><p>+60<p>+2<p>+31<p>+1<p>+140</article><footer>7</footer>
<header><a href=x>3</a><p>6</header><main><h1>+7</h1><p>+25</p><p>+80</p><h2>+3</h2><p>+4</p><p>+44</p></main><aside><h3>2</h3><p>22</p><ul><li><a href=x>6</a><li><a href=x>8</a></ul></aside><footer><p>12</p></footer>
<div class=cookie-notice><p>24</p><button>1</button></div><nav><a href=x>1</a> <a href=x>1</a></nav><article><header><h1>+8</h1><p>+5</p></header><p>+12</p><p>+95</p><ul><li>+4</li><li>+9</li></ul><p>+1</p></article><section class=comments><h3>1</h3><p>35</p><p>3</p><p>60</p></section><footer>5</footer>
<div id=menu><a href=x>1</a><a href=x>2</a></div><div id=content><h1>+6</h1><p>+70</p><p>+3</p><p>+52</p><blockquote>+18</blockquote><p>+2</p></div><div id=sidebar><p>15</p><p>40</p></div><div id=footer>9</div>
<div><a href=x>1</a> <a href=x>1</a> <a href=x>2</a></div><div><h1>+5</h1></div><div>+64</div><div>+90</div><div>+38</div><div><a href=x>6</a></div><div><a href=x>7</a></div><div>4</div>
<p><a href=x>2</a></p><p><a href=x>1</a></p><p>+48</p><p>+75</p><p>+20</p><p>+55</p><p><a href=x>5</a></p><p>3</p>
<div class=banner><p>14</p></div><main><article><h1>+10</h1><p>+33</p><div class=advert>11</div><p>+66</p><aside><p>26</p></aside><p>+8</p><table><tr><td>+1</td><td>+2</td></tr></table><p>+29</p><form><p>9</p><input></form></article></main><footer><a href=x>2</a></footer>
<form class=search><label>2</label><input></form><article><p>+6</p><p>+110</p><p>+<a href=x>4</a></p><p>+3</p><p>+27</p></article><div class=related><h3>2</h3><p><a href=x>7</a></p><p>19</p></div><div id=comments><article class=comment><p>42</p></article><article class=comment><p>5</p></article></div>
<form id=page><div class=menu><a href=x>1</a></div><article><h1>+4</h1><p>+37</p><p>+58</p></article><div class=footer>8</div></form>
<header role=banner><h1>3</h1><p>10</p></header><div class=post><h2>+6</h2><p>+41</p><p>+1</p><p>+88</p><p>+15</p></div><div class=newsletter><p>17</p><p>30</p></div><div role=contentinfo><p>13</p><p>28</p></div>
<ul><li><a href=x>1</a></li><li><a href=x>1</a></li></ul><h1>+7</h1><p>+34</p><p>+46</p><p>+72</p><ul><li>+14</li><li>+17</li></ul><p>+23</p><div class=share>3</div><ul><li><a href=x>4</a></li><li><a href=x>5</a></li></ul><p>6</p>
<article><h1>+3</h1><p>+2</p></article><footer><p>33</p></footer><div class=modal><p>45</p></div>
<nav><p>21</p></nav><main><p>+1</p></main><aside><p>52</p></aside><footer><p>48</p></footer>
<div><a href=x>2</a> 1</div><div>+85</div><div>+62</div><div><a href=x>3</a> 2</div><div>2</div>
<div class=sponsored><p>36</p></div><div>+120</div><div>+57</div><div class=notice>31</div><div>+43</div><div><a href=x>9</a></div>
<nav><a href=x>1</a></nav><article><h1>+5</h1><p>+30</p><p>+<a href=x>3</a></p><p>+3</p></article>
<main><p>+44</p><ul><li>+<a href=x>2</a></li><li>+<a href=x>4</a></li></ul><p>+1</p></main>
<article><p>+2</p></article>
<article><h1>+4</h1><p>+16</p><p>+51</p><p>+<a href=x>8</a></p><p>+5
+150
4
<p>+42</p><p>+1</p><p>+67</p>
"""


def labelled_blocks() -> list[tuple[list[float], float]]:
    """The labelled table: figures and label of every block of LABELLED."""
    rows = []
    for page in LABELLED.strip().splitlines():
        text = re.sub(r"(?<=[>+ ])(\d+)(?=[< ]|$)|^(\d+)$", lambda m: " ".join(["w"] * int(m[0])), page.replace("+", "§"))
        text = re.sub(r"§(<[^>]*>)?(\d+)?", lambda m: (m[1] or "") + "§" + " ".join(["w"] * int(m[2] or 0)), text)
        found = blocks(text)
        rows += [(list(map(float, f)), float(b.text.startswith("§"))) for b, f in zip(found, figures([b._replace(text=b.text.replace("§", "")) for b in found]))]
    return rows


class Tree(NamedTuple):
    """A fitted tree as arrays: inner nodes ask ``feature <= threshold``; leaves have feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    label: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        while True:
            f = self.feature[at]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                return self.label[at]
            here = at[inner]
            at[inner] = np.where(x[inner, f[inner]] <= self.threshold[here], self.left[here], self.right[here])


def fit(spark: SparkSession, rows: list[tuple[list[float], float]] | None = None, depth: int = 6) -> Tree:
    """The decision tree of labelled blocks (default: the table of this module)."""
    rows = labelled_blocks() if rows is None else rows
    table = spark.createDataFrame([(Vectors.dense(x), y) for x, y in rows], ["features", "label"])
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=128, minInstancesPerNode=2, seed=1).fit(table.coalesce(1))
    nodes: list[list] = []

    def add(node) -> int:
        k = len(nodes)
        nodes.append([-1, 0.0, 0, 0, node.prediction()])
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            nodes[k][:2] = [split.featureIndex(), split.threshold()]
            nodes[k][2], nodes[k][3] = add(node.leftChild()), add(node.rightChild())
        return k

    add(model._java_obj.rootNode())
    f, t, left, right, label = map(np.array, zip(*nodes))
    return Tree(f, t, left, right, label)


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    """The main text of each page."""
    found = [blocks(p) for p in pages]
    sizes = [len(b) for b in found]
    if not sum(sizes):
        return [""] * len(pages)
    keep = tree.predict(np.concatenate([figures(b) for b in found if b])) > 0.5
    out, k = [], 0
    for b in found:
        out.append("\n".join(x.text for x, y in zip(b, keep[k:k + len(b)]) if y))
        k += len(b)
    return out


#: Characters of pages worked on at a time.
SLICE = 8 << 20


def extract(pages: DataFrame, column: str = "html", tree: Tree | None = None) -> DataFrame:
    """All columns of ``pages`` with the main text as ``main_text`` instead of ``column``.

    A null page counts as empty and has the empty text; so has a page without main text. Repeated rows stay. A column of that
    name is replaced. An empty table gives an empty one.
    """
    tree = tree or fit(pages.sparkSession)
    rest = [f for f in pages.schema.fields if f.name not in (column, "main_text")]
    schema = T.StructType([*rest, T.StructField("main_text", T.StringType())])
    names = [f.name for f in rest]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            html_ = b.column(b.num_columns - 1)
            at = 0
            while at < b.num_rows:
                size, texts = 0, []
                while at + len(texts) < b.num_rows and (not texts or size < SLICE):
                    texts.append(html_[at + len(texts)].as_py() or "")
                    size += len(texts[-1])
                part = b.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(main_texts(texts, tree), pa.string())], names=[*names, "main_text"])
                at += len(texts)

    return pages.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{column}`").cast("string").alias("__page")).mapInArrow(run, schema)
