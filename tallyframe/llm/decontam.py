"""Benchmark decontamination: every passage queries a BM25 index of the test items with block-max skipping.

Scores are divided by the item's score against itself, so one threshold holds for all items. Items stand in the
index ordered by length, in blocks; each term keeps its largest impact per block. A passage visits only blocks whose
summed maxima of its terms reach the threshold, and gets every item above it. Hits are then verified on the words:
shingles of the whole item, words of its question and of its answer (the last sentence).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import row_hash
from tallyframe.session import checkpointed

K1, B = 1.2, 0.75
THRESHOLD = 0.6
SHINGLE = 5
OVERLAP = 0.8
ANSWER_OVERLAP = 0.5
ITEMS_PER_INDEX = 2000  # items in one broadcast index; more items take more passes over the documents
BYTES_PER_INDEX = 8 << 20
BLOCK = 4
CACHE = 400_000
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_SENTENCE = re.compile(r"[.?!\n]+")


def word(chunk: str) -> str:
    """A white-space delimited chunk in lower case without punctuation around it; may be empty."""
    return _EDGE.sub("", chunk.lower())


def words(text: str) -> list[str]:
    return [w for w in map(word, text.split()) if w]


def shingles(seq: list[str], size: int = SHINGLE) -> set[tuple[str, ...]]:
    """All runs of ``size`` words; a shorter sequence is one run."""
    return {tuple(seq[i:i + size]) for i in range(max(1, len(seq) - size + 1))} if seq else set()


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of the item without its last sentence, and of that sentence; one sentence alone is cut at two thirds."""
    parts = [p for p in (words(s) for s in _SENTENCE.split(text)) if p]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    seq = parts[0] if parts else []
    cut = max(1, (2 * len(seq)) // 3)
    return seq[:cut], seq[cut:]


def share(part: list[str], of: set[str]) -> float:
    return sum(w in of for w in part) / len(part) if part else 1.0


@dataclass
class Index:
    """Inverted index of one set of items: impacts already divided by the item's own score."""

    ids: list
    texts: list[str]
    terms: dict[str, int]
    bound: np.ndarray  # terms x blocks: largest impact
    postings: list[dict[int, tuple[np.ndarray, np.ndarray]]]  # per block: term -> items, impacts
    window: int
    n: int
    verify: dict[int, tuple] = field(default_factory=dict)

    def parts(self, i: int) -> tuple:
        if i not in self.verify:
            q, a = question_answer(self.texts[i])
            self.verify[i] = (shingles(words(self.texts[i])), q, a)
        return self.verify[i]


def build_index(items: list[tuple], df: dict[str, int], n_items: int, avg_len: float) -> Index:
    """``items`` are ``(id, text)``; document frequencies, number and mean length are those of all items."""
    items = sorted(((i, t, words(t)) for i, t in items), key=lambda x: (len(x[2]), x[1], str(x[0])))
    items = [x for x in items if x[2]]
    terms: dict[str, int] = {}
    blocks = max(1, -(-len(items) // BLOCK))
    postings: list[dict[int, tuple[list, list]]] = [{} for _ in range(blocks)]
    for k, (_, _, seq) in enumerate(items):
        tf: dict[str, int] = {}
        for w in seq:
            tf[w] = tf.get(w, 0) + 1
        norm = K1 * (1 - B + B * len(seq) / max(avg_len, 1e-9))
        imp = {w: math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + norm) for w, n in tf.items()}
        own = sum(imp.values())
        for w, v in imp.items():
            t = terms.setdefault(w, len(terms))
            a, b = postings[k // BLOCK].setdefault(t, ([], []))
            a.append(k)
            b.append(v / own)
    bound = np.zeros((len(terms) + 1, blocks), np.float32)
    fixed = []
    for b, block in enumerate(postings):
        fixed.append({t: (np.array(i), np.array(v)) for t, (i, v) in block.items()})
        for t, (_, v) in block.items():
            bound[t, b] = max(v)
    longest = max((len(s) for _, _, s in items), default=1)
    return Index([x[0] for x in items], [x[1] for x in items], terms, bound, fixed, max(SHINGLE, longest), len(items))


def retrieve(index: Index, terms: np.ndarray, threshold: float) -> dict[int, float]:
    """All items whose score for these distinct terms reaches the threshold; most passages have no block to visit."""
    caps = index.bound[terms].sum(axis=0)
    if caps.max() < threshold - 1e-6:
        return {}
    found: dict[int, float] = {}
    for b in np.flatnonzero(caps >= threshold - 1e-6):
        block, acc = index.postings[b], {}
        for t in terms.tolist():
            hit = block.get(t)
            if hit is not None:
                for i, v in zip(*hit):
                    acc[i] = acc.get(i, 0.0) + v
        found |= {int(i): float(v) for i, v in acc.items() if v >= threshold - 1e-9}
    return found


class _Terms(dict):
    """Chunk -> term number, -1 for a word outside the index, -2 for no word."""

    def __init__(self, index: Index):
        self.index = index

    def __missing__(self, chunk: str) -> int:
        if len(self) > CACHE:
            self.clear()
        w = word(chunk)
        t = self[chunk] = self.index.terms.get(w, -1) if w else -2
        return t


def match_text(text: str, index: Index, lookup: dict, threshold: float = THRESHOLD) -> dict[int, tuple[float, float, float, float]]:
    """item -> best ``(bm25, overlap, question, answer)`` among the windows where it is verified."""
    if not index.n:
        return {}
    chunks = text.split()
    at = np.array([lookup[c] for c in chunks], np.int64)
    keep = np.flatnonzero(at != -2)
    at = at[keep]
    known = at >= 0
    out: dict[int, tuple[float, float, float, float]] = {}
    best = index.bound.max(axis=1)
    run = np.concatenate([[0.0], np.cumsum(np.where(known, best[at], 0.0))])
    step = index.window
    for lo in range(0, max(1, len(at) - step), step):
        hi = min(len(at), lo + 2 * step)
        if run[hi] - run[lo] < threshold - 1e-6:
            continue
        t = np.sort(at[lo:hi][known[lo:hi]])
        t = t[np.concatenate([[True], t[1:] != t[:-1]])]
        hits = retrieve(index, t, threshold)
        if not hits:
            continue
        seq = [word(chunks[i]) for i in keep[lo:hi].tolist()]
        have, bag = shingles(seq), set(seq)
        for i, score in hits.items():
            whole, q, a = index.parts(i)
            size = len(next(iter(whole)))
            there = have if size == SHINGLE else shingles(seq, size)
            got = (score, len(whole & there) / len(whole), share(q, bag), share(a, bag))
            if got[1] >= OVERLAP and got[2] >= OVERLAP and got[3] >= ANSWER_OVERLAP:
                out[i] = max(out.get(i, got), got, key=lambda x: (x[1], x[0]))
    return out


def _indexes(items: DataFrame, item_id: str, text: str) -> Iterator[Index]:
    """Indexes of at most ITEMS_PER_INDEX items (or BYTES_PER_INDEX of text) each; statistics are those of all items."""
    base = checkpointed(items.select(F.col(item_id).cast("long").alias("i"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")))
    total = base.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("t")).alias("b")).first()
    n, size = total["n"], total["b"] or 0
    if not n:
        return

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seqs = [words(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([sorted(set(s)) for s in seqs], pa.list_(pa.string())), pa.array([len(s) for s in seqs], pa.int64())], names=["w", "n"])

    seqs = checkpointed(base.select("t").mapInArrow(split, "w array<string>, n long"))
    df = checkpointed(seqs.select(F.explode("w").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("d")))
    mean = seqs.agg(F.avg("n")).first()[0]
    parts = max(-(-n // ITEMS_PER_INDEX), -(-size // BYTES_PER_INDEX))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(parts))
    for k in range(parts):
        rows = [(r["i"], r["t"]) for r in base.where(part == k).collect()]
        mine = base.sparkSession.createDataFrame([(w,) for w in sorted({w for _, t in rows for w in words(t)})], "w string")
        freq = {r["w"]: r["d"] for r in (df.collect() if parts == 1 else df.join(mine, "w").collect())}
        yield build_index(rows, freq, n, mean)


MATCH = "doc_id long, h long, item_id long, bm25 double, overlap double, question_overlap double, answer_overlap double"


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, h, item_id, bm25, overlap, question_overlap, answer_overlap)``: each document and item it contains.

    ``h`` is the hash of the document's row. The items are queried in blocks, each a pass over the documents
    without a shuffle. Null or empty texts and items match nothing; repeated items and documents are each reported;
    no items or documents give no rows. Scores are the best verified window's.
    """
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(docs).alias("h"), F.col(text).cast("string").alias("t"))
    out = None
    for index in _indexes(items, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            lookup = _Terms(index)
            for b in batches:
                rows = []
                for d, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                    for i, got in match_text(t or "", index, lookup, threshold).items():
                        rows.append((d, h, index.ids[i], *got))
                cols = list(zip(*rows)) if rows else [()] * 7
                types = [pa.int64()] * 3 + [pa.float64()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)],
                                                 names=["doc_id", "h", "item_id", "bm25", "overlap", "question_overlap", "answer_overlap"])

        part = base.mapInArrow(run, MATCH)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], MATCH)


def keep_uncontaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                        item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no test item, with the columns they came with; a filter inside each task, no join."""
    out = docs
    for index in _indexes(items, item_id, item_text):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        at = docs.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            lookup = _Terms(index)
            for b in batches:
                yield b.filter(pa.array([not match_text(t or "", index, lookup, threshold) for t in b.column(at).to_pylist()], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
