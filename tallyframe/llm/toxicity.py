"""Toxicity by maximum-scoring segments: every significant toxic passage, calibrated by extreme-value statistics.

Token weights are log-odds of the two classes under hierarchical Dirichlet priors: a word's prior is the
posterior of its prefixes (4, 5, then 6 letters), and grows with the word's share of all documents. The weights
less a drift are scanned once per text for all maximal scoring segments. Under clean text the best score of n
tokens follows an extreme-value law with parameters lambda and K, so a segment counts by ``lambda*S - ln(K*n)``;
a two-feature logistic curve turns the document's best and summed excess into a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import map_texts
from tallyframe.session import checkpointed

MAX_LABELLED = 100_000  # labelled rows the classifier learns from, the first by hash of the id
PREFIXES = (4, 5, 6)
DRIFT = 0.7
PRIOR = 3.0
SURE = 0.01  # a prior's share stays this far from 0 and 1
BACKGROUND = 1000.0
CACHE = 200_000  # distinct words kept per task
STEP = 100_000  # tokens whose weights are looked up together; a longer text is a step of its own
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_CHUNK = re.compile(r"\S+")


_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of the words' features, a column each from coarse to fine (prefixes, then the word), and which there are.

    A name is a hash of code points by their places, so sums up to a place give every prefix's.
    """
    size = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    begin = np.cumsum(size) - size
    place = np.arange(len(code)) - np.repeat(begin, size)
    powers = np.cumprod(np.full(int(size.max(initial=0)) + 1, _C, np.uint64))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(code + _A) * powers[place], dtype=np.uint64)])
    names, has = np.zeros((len(words), len(PREFIXES) + 1), np.uint64), np.zeros((len(words), len(PREFIXES) + 1), bool)
    for k, n in enumerate(PREFIXES):
        i = np.flatnonzero(size > n)
        names[i, k] = _mix(total[begin[i] + n] - total[begin[i]] + np.uint64(n))
        has[i, k] = True
    names[:, -1], has[:, -1] = _mix(total[begin + size] - total[begin]), size > 0
    return names, has


def _word(chunk: str) -> str:
    low = chunk.lower()
    return low if low.isalpha() else _EDGE.sub("", low)


@dataclass
class Model:
    """Evidence of every feature with a labelled occurrence, by its name in order; bounded by the labelled sample."""

    keys: np.ndarray
    toxic: np.ndarray
    clean: np.ndarray
    prior: np.ndarray
    n_toxic: float
    n_clean: float
    lam: float = 1.0
    k: float = 0.1
    curve: tuple[float, float, float] = (-1.0, 0.0, 1.0)

    def evidence(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Toxic and clean occurrences and the prior's strength; a feature that no labelled text has passes its prior on."""
        at, known = _places(self.keys, names)
        out = np.zeros(len(names)), np.zeros(len(names)), np.full(len(names), PRIOR)
        for o, a in zip(out, (self.toxic, self.clean, self.prior)):
            o[known] = a[at[known]]
        return out

    def weights(self, chunks: list[str]) -> np.ndarray:
        """Log-odds of white-space delimited tokens less the drift; a token without letters or digits has the drift only."""
        names, has = _features([_word(c) for c in chunks])
        base = self.n_toxic / self.n_clean
        odds = np.full(len(chunks), base)
        for k in range(names.shape[1]):
            i = np.flatnonzero(has[:, k])
            q = np.clip(odds[i] / (1 + odds[i]), SURE, 1 - SURE)  # a sure prefix never decides alone
            toxic, clean, s = self.evidence(names[i, k])
            odds[i] = (toxic + s * q) / (clean + s * (1 - q))
        return np.where(has[:, -1], np.log(odds / base) - DRIFT, -DRIFT)

    def weight(self, chunk: str) -> float:
        return float(self.weights([chunk])[0])


def _places(keys: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where names stand in the ordered keys, and which of them do."""
    at = np.searchsorted(keys, names)
    known = at < len(keys)
    known[known] = keys[at[known]] == names[known]
    return at, known


class _Counts:
    """Occurrences of the features of texts by class, handed over whenever CACHE distinct tokens have come together."""

    def __init__(self, classes: int):
        self.words = [Counter() for _ in range(classes)]

    def full(self) -> bool:
        return sum(map(len, self.words)) > CACHE

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(name, class, occurrences)``, one for each token and feature; starts anew."""
        out = []
        for k, c in enumerate(self.words):
            names, has = _features([_word(chunk) for chunk in c])
            n = np.fromiter(c.values(), np.int64, len(c))
            out.append((names[has], np.full(has.sum(), k, np.int8), np.repeat(n, has.sum(axis=1))))
            c.clear()
        return tuple(map(np.concatenate, zip(*out)))


class _Weights:
    """Weights of the tokens of one task, kept for at most CACHE distinct ones."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def of(self, texts: list[list[str]]) -> Iterator[np.ndarray]:
        """The weights of each list of tokens; what is not known yet is computed for some texts together."""
        at = 0
        while at < len(texts):
            new, end, n = set(), at, 0
            while end < len(texts) and (end == at or n + len(texts[end]) < STEP):
                n += len(texts[end])
                new.update(texts[end])
                end += 1
            if len(self.known) + len(new) > CACHE:
                self.known.clear()
            new = list(new.difference(self.known))
            self.known.update(zip(new, self.model.weights(new).tolist()))
            for chunks in texts[at:end]:
                yield np.fromiter(map(self.known.__getitem__, chunks), float, len(chunks))
            at = end


def maximal_segments(w: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` in one linear scan; ends are exclusive.

    Runs of positive weights are one step each. A candidate keeps the running totals before (``l``) and after
    (``r``) it; it is extended back over the last candidate that began lower, until none did or that one ended higher.
    """
    pos = w > 0
    if not pos.any():
        return []
    edge = np.flatnonzero(np.diff(np.concatenate([[False], pos, [False]]).astype(np.int8)))
    total = np.concatenate([[0.0], np.cumsum(w)])
    seg: list[tuple[int, int, float, float]] = []
    back: list[int] = []  # for each candidate, the last before it whose left total is smaller, or -1
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        l, r = total[a], total[b]
        while True:
            j = len(seg) - 1
            while j >= 0 and seg[j][2] >= l:
                j = back[j]
            if j < 0 or seg[j][3] >= r:
                seg.append((a, b, l, r))
                back.append(j)
                break
            a, l = seg[j][0], seg[j][2]
            del seg[j:], back[j:]
    return [(a, b, float(r - l)) for a, b, l, r in seg]


def _clean_law(hist: Counter) -> float:
    """lambda > 0 with E[exp(lambda * w)] = 1 over the token weights of clean text."""
    w = np.array([k / 16 for k in hist]) if hist else np.array([-DRIFT])
    p = np.array(list(hist.values()), float) if hist else np.ones(1)
    p /= p.sum()
    if w.max() <= 0:
        return 1.0
    lo, hi = 1e-3, 1.0
    f = lambda x: float((p * np.exp(x * w)).sum()) - 1
    while f(hi) < 0 and hi < 64:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return max(hi, 0.05)


def excess(scores: list[float], n: int, model: Model) -> tuple[float, float]:
    """Best and summed excess of a document's segments over what clean text of its length gives."""
    if not scores:
        return 0.0, 0.0
    x = model.lam * np.array(scores) - np.log(model.k * max(n, 1) + 1e-9)
    return float(min(max(x.max(), 0.0), 50.0)), float(np.log1p(x[x > 0].sum()))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic fit of two features by Newton steps, halved until the loss falls: full steps can swing for ever."""
    a = np.column_stack([np.ones(len(x)), x])
    pen = np.diag([1e-3, 0.1, 0.1])
    loss = lambda w: float(np.logaddexp(0, a @ w).sum() - y @ (a @ w) + w @ pen @ w / 2)
    w = np.zeros(3)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + pen
        step = np.linalg.solve(h, a.T @ (y - p) - pen @ w)
        size = 1.0
        while loss(w + size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w + size * step
        if size <= 1e-6 or np.abs(size * step).max() < 1e-8:
            break
    return tuple(map(float, w))


def labelled_rows(labels: DataFrame, allowed: Column, most: int, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """``(__id, __y, __fit)``: a sample of the labels, at most ``most`` ids by hash order; conflicting labels: the larger.

    Null ids and labels other than 0 and 1 are left out. A fifth of the ids is kept for the calibration.
    """
    rows = labels.where(allowed & F.col(doc_id).isNotNull() & F.col(label).isin(0, 1)).groupBy(doc_id).agg(F.max(label).alias("__y"))
    picked = rows.orderBy(F.xxhash64(F.col(doc_id).cast("string")), doc_id).limit(most)
    fit = F.pmod(F.xxhash64(F.lit("calibrate"), F.col(doc_id).cast("string")), F.lit(5)) != 0
    return checkpointed(picked.select(F.col(doc_id).alias("__id"), F.col("__y").cast("int"), fit.alias("__fit")))


def train(docs: DataFrame, labels: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          max_labelled: int = MAX_LABELLED) -> Model:
    """Learns weights and calibration. ``allowed`` is a condition on the label rows that may be learned from.

    The labelled sample is bounded by ``max_labelled``, so it is broadcast, and so are the features its texts have;
    each is counted by itself. How often they stand in the whole corpus is then counted over all documents. Repeated
    rows count as often as they stand; a null text has no tokens. Without labels of both classes, as in an empty
    table, all weights are the drift and every score is low.
    """
    sample = labelled_rows(labels, allowed, max_labelled, doc_id, label)
    base = docs.select(F.col(doc_id).alias("__id"), F.col(text).cast("string").alias("__t"))
    marked = base.join(F.broadcast(sample), "__id", "left").select(
        "__t", F.when(F.col("__fit"), F.col("__y")).otherwise(-1).alias("__y"), F.coalesce(~F.col("__fit"), F.lit(False)).alias("__cal"),
        F.col("__y").alias("__label"))

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(2)

        def flush() -> pa.RecordBatch:
            names, classes, n = counts.take()
            keys, at = np.unique(names, return_inverse=True)
            sums = [np.bincount(at, n * (classes == k), len(keys)).astype(np.int64) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *map(pa.array, sums)], names=["f", "c", "t"])

        for batch in batches:
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.words[y].update((t or "").split())
                if counts.full():
                    yield flush()
        yield flush()

    rows = marked.where("__y >= 0").select("__t", F.col("__y").cast("int")).mapInArrow(labelled, "f long, c long, t long")
    got = checkpointed(rows.groupBy("f").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))).toArrow()
    keys, c, t = got.column(0).to_numpy().view(np.uint64), got.column(1).to_numpy(), got.column(2).to_numpy()
    order = np.argsort(keys)
    keys, clean, toxic = keys[order], c[order].astype(np.float32), t[order].astype(np.float32)
    model = Model(keys, toxic, clean, np.full(len(keys), PRIOR, np.float32), float(t.sum()), float(c.sum()))
    if not model.n_toxic or not model.n_clean:
        model.n_toxic = model.n_clean = 1.0
        model.toxic, model.clean = np.zeros_like(toxic), np.zeros_like(clean)
        return model
    sent = docs.sparkSession.sparkContext.broadcast(keys)

    def background(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = sent.value, _Counts(1)
        sums = np.zeros(len(keys) + 1, np.int64)  # the last one is the total of all features, known or not

        def flush() -> None:
            names, _, n = counts.take()
            at, known = _places(keys, names)
            np.add.at(sums, at[known], n[known])
            sums[-1] += n.sum()

        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.words[0].update((t or "").split())
                if counts.full():
                    flush()
        flush()
        some = np.flatnonzero(sums)
        for at in range(0, len(some), 100_000):
            s = some[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(sums[s])], names=["i", "n"])

    every = base.select("__t").mapInArrow(background, "i int, n long").groupBy("i").agg(F.sum("n").alias("n"))
    got = checkpointed(every).toArrow()
    sums = np.zeros(len(keys) + 1, np.int64)
    sums[got.column(0).to_numpy()] = got.column(1).to_numpy()
    model.prior = (PRIOR + BACKGROUND * sums[:-1] / max(sums[-1], 1)).astype(np.float32)
    return _calibrate(marked.where("__cal"), model)


def _calibrate(held: DataFrame, model: Model) -> Model:
    """lambda and K from the clean calibration rows, then the logistic curve; the rows are part of the bounded sample."""
    sent = held.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _Weights(sent.value)
        for batch in batches:
            out = []
            texts = [t or "" for t in batch.column(0).to_pylist()]
            weights = (x for part in _parts(texts) for x in w.of([t.split() for t in part]))
            for x, y in zip(weights, batch.column(1).to_pylist()):
                hist = Counter(np.round(np.clip(x, -8, 8) * 16).astype(int).tolist()) if y == 0 else {}
                out.append((y, len(x), [s for *_, s in maximal_segments(x)], list(hist.keys()), list(hist.values())))
            cols = list(zip(*out)) if out else [()] * 5
            types = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)], names=["y", "n", "s", "hk", "hv"])

    rows = checkpointed(held.select("__t", F.col("__label").cast("int")).mapInArrow(score, "y int, n long, s array<double>, hk array<int>, hv array<long>"))
    hist = rows.select(F.explode(F.map_from_arrays("hk", "hv")).alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v"))
    model.lam = _clean_law(Counter({r["k"]: r["v"] for r in hist.collect()}))
    best = F.coalesce(F.array_max("s"), F.lit(0.0))
    shift = rows.where("y = 0 and n > 0").agg(F.avg(F.lit(model.lam) * best - F.log(F.col("n")))).first()[0]
    model.k = float(np.exp(min(max((shift if shift is not None else -2.0) - 0.5772156649, -30.0), 5.0)))
    lam, k = model.lam, model.k
    over = F.transform("s", lambda x: F.lit(lam) * x - F.log(F.lit(k) * F.greatest("n", F.lit(1)) + F.lit(1e-9)))
    feats = rows.select("y", F.least(F.greatest(F.coalesce(F.array_max(over), F.lit(0.0)), F.lit(0.0)), F.lit(50.0)).alias("x1"),
                        F.log1p(F.aggregate(over, F.lit(0.0), lambda acc, x: acc + F.greatest(x, F.lit(0.0)))).alias("x2")).toArrow()
    y = feats.column(0).to_numpy().astype(float)
    if len(y):
        model.curve = _logistic(np.column_stack([feats.column(1).to_numpy(), feats.column(2).to_numpy()]), y)
    return model


SEGMENTS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("excess", T.DoubleType())]))


def score_texts(docs: DataFrame, model: Model, text: str = "text", name: str = "toxicity", segments: str = "toxic_segments") -> DataFrame:
    """Adds the score (0 to 1) and the significant segments as character spans (end exclusive) with their excess.

    A null or empty text has no segments and the score of a text without any; repeated rows get equal scores, an empty
    table gives no rows. Other columns pass through; give ``name`` and ``segments`` that none of them has.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    task: list[_Weights] = []  # every task has its own copy, gone with the task

    def run(texts: list[str]) -> dict[str, pa.Array]:
        model, scores, spans = sent.value, [], []
        if not task:
            task.append(_Weights(model))
        b0, b1, b2 = model.curve
        for t, w in zip(texts, (x for part in _parts(texts) for x in task[0].of([t.split() for t in part]))):
            found = maximal_segments(w)
            x1, x2 = excess([s for *_, s in found], len(w), model)
            scores.append(1 / (1 + np.exp(-np.clip(b0 + b1 * x1 + b2 * x2, -30, 30))))
            base = np.log(model.k * max(len(w), 1) + 1e-9)
            good = [(a, b, model.lam * s - base) for a, b, s in found if model.lam * s > base]
            if good:
                at = [m.span() for m in _CHUNK.finditer(t)]
                good = [{"start": at[a][0], "end": at[b - 1][1], "excess": float(x)} for a, b, x in good]
            spans.append(good)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("excess", pa.float64())]))
        return {name: pa.array(scores, pa.float64()), segments: pa.array(spans, kind)}

    return map_texts(docs, run, {name: T.DoubleType(), segments: SEGMENTS}, text)


def _parts(texts: list[str], most: int = 2_000_000) -> Iterator[list[str]]:
    """The texts in runs of about ``most`` characters, so that few are held as tokens at a time."""
    at = size = 0
    for k, t in enumerate(texts):
        if k > at and size + len(t) > most:
            yield texts[at:k]
            at, size = k, 0
        size += len(t)
    if at < len(texts):
        yield texts[at:]


def keep_clean(docs: DataFrame, model: Model, text: str = "text", at: float = 0.5) -> DataFrame:
    """The documents whose score is below ``at``, with the columns they came with."""
    scored = score_texts(docs.withColumn("__t", F.col(text).cast("string")), model, "__t", "__toxicity", "__segments")
    return scored.where(F.col("__toxicity") < at).select(*docs.columns)
