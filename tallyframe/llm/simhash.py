"""SimHash near-duplicates: vantage-point trees over the fingerprints, exact links, one class per group.

On the whole 64 bits the distances of unrelated fingerprints crowd around 32, so a vantage point with search
radius 4 prunes only a third of the visits a level. The trees therefore measure the distance inside one band of
bits. With ``bands`` bands, two fingerprints that differ in at most ``distance`` bits differ in at most
``distance // bands`` bits of some band; in that band's tree the triangle inequality
``|d(p,v) - d(q,v)| <= d(p,q)`` prunes with that small radius. With more bands than differing bits the radius is 0
and nothing is copied; with fewer bands the fingerprints near a boundary also visit the shard across it.
Each shard then compares all 64 bits, so the links are exact for every number of bands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import map_texts, row_hash
from tallyframe.llm.components import connected_components
from tallyframe.session import checkpointed

DISTANCE = 4
BANDS = 5
LEAF = 1024  # fingerprints a shard should hold
SAMPLE = 65_536  # fingerprints the trees are shaped by; every fingerprint is routed
BLOCK = 4096  # a shard with more is compared block against block


def simhash(text: str, size: int = 4) -> int:
    """64-bit SimHash of the word shingles, repeats included; fewer words than ``size``: one shingle; none: 0."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes both touch ASCII only
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    last = ends[size - 1:] if len(words) >= size else ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    pairs = list(zip(starts[:n].tolist(), last.tolist()))
    for at in range(0, n, 65_536):
        h = np.fromiter((digest(joined[a:b], 42) for a, b in pairs[at:at + 65_536]), np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, text: str = "text", size: int = 4, name: str = "__fp") -> DataFrame:
    """Adds the fingerprint as a signed long; all other columns pass through. Null text counts as empty."""

    def run(texts: list[str]) -> dict[str, pa.Array]:
        return {name: pa.array(np.array([simhash(t, size) for t in texts], np.uint64).view(np.int64))}

    return map_texts(docs, run, {name: T.LongType()}, text)


def _band_masks(bands: int) -> list[int]:
    cuts = [round(64 * i / bands) for i in range(bands + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]


class VantageTree:
    """Median-split vantage-point tree over one band, shaped by a bounded sample, stored as flat arrays."""

    def __init__(self, sample: np.ndarray, mask: int, leaf: int):
        self.mask = np.uint64(mask)
        self.vantage, self.mu, self.left, self.right = [], [], [], []
        self._grow(sample, max(1, leaf))
        self.vantage = np.array(self.vantage, np.uint64)
        self.mu, self.left, self.right = (np.array(x, np.int64) for x in (self.mu, self.left, self.right))

    def _node(self) -> int:
        for x, v in ((self.vantage, 0), (self.mu, 0), (self.left, -1), (self.right, -1)):
            x.append(v)
        return len(self.mu) - 1

    def _grow(self, sample: np.ndarray, leaf: int) -> None:
        todo = [(self._node(), sample)]
        while todo:
            at, pts = todo.pop()
            if len(pts) <= leaf:
                continue
            for v in pts[:: max(1, len(pts) // 8)][:8]:  # a vantage point that splits, if there is one
                d = np.bitwise_count((pts ^ v) & self.mask).astype(np.int64)
                mu = int(np.median(d))
                near = d <= mu if (d > mu).any() else d < mu
                mu = mu if (d > mu).any() else mu - 1
                if near.any() and not near.all():
                    break
            else:
                continue
            self.vantage[at], self.mu[at] = int(v), mu
            self.left[at], self.right[at] = self._node(), self._node()
            todo += [(self.left[at], pts[near]), (self.right[at], pts[~near])]

    def route(self, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the points and the shards each must be in: its own and those its radius reaches."""
        pts, node, done = np.arange(len(fp)), np.zeros(len(fp), np.int64), []
        while len(pts):
            end = self.left[node] < 0
            done.append((pts[end], node[end]))
            pts, node = pts[~end], node[~end]
            d = np.bitwise_count((fp[pts] ^ self.vantage[node]) & self.mask).astype(np.int64)
            lo, hi = d - radius <= self.mu[node], d + radius > self.mu[node]
            pts, node = np.concatenate([pts[lo], pts[hi]]), np.concatenate([self.left[node[lo]], self.right[node[hi]]])
        return np.concatenate([p for p, _ in done]), np.concatenate([n for _, n in done])


def links_within(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of the links at most ``distance`` bits apart: it has the components of all of them.

    Each fingerprint is compared with those not yet reached; what is reached leaves the comparison. So a dense
    group costs about one pass and never gives all its pairs.
    """
    fp = np.unique(fp)
    rest, at, src, dst = np.arange(len(fp)), fp, [], []
    while len(rest):
        stack, rest, at = [rest[0]], rest[1:], at[1:]
        while stack and len(rest):
            p = stack.pop()
            near = np.bitwise_count(at ^ fp[p]) <= distance
            if near.any():
                hit = rest[near]
                src.append(np.full(len(hit), fp[p], fp.dtype))
                dst.append(fp[hit])
                stack.extend(hit)
                rest, at = rest[~near], at[~near]
    if not src:
        return np.empty(0, fp.dtype), np.empty(0, fp.dtype)
    return np.concatenate(src), np.concatenate(dst)


def fingerprint_links(fps: DataFrame, distance: int = DISTANCE, bands: int = BANDS, leaf: int = LEAF, block: int = BLOCK,
                      sample: int = SAMPLE) -> DataFrame:
    """Distinct ``fp`` longs to links ``(a, b)`` that connect exactly what is within ``distance`` bits.

    A shard that holds more than ``block`` fingerprints (many that share a band) is cut by a hash into blocks, and
    every two of its blocks are compared in a task of their own, so no task holds more than two blocks.
    """
    n = fps.count()
    shape = np.array([r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()], np.int64).view(np.uint64)
    per_leaf = max(4, leaf * len(shape) // max(n, 1))
    trees = [VantageTree(shape, m, per_leaf) for m in _band_masks(bands)]
    radius = distance // bands

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for t, tree in enumerate(trees):
                pts, node = tree.route(fp, radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pts), t, np.int32)), pa.array(node.astype(np.int32)), pa.array(fp[pts].view(np.int64))],
                    names=["tree", "leaf", "fp"])

    routed = fps.select("fp").mapInArrow(route, "tree int, leaf int, fp long")
    sizes = checkpointed(routed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
                         .select("tree", "leaf", F.ceil(F.col("n") / block).cast("int").alias("s")))
    routed = routed.join(sizes, ["tree", "leaf"], "left").withColumn("s", F.coalesce("s", F.lit(1)))
    routed = routed.withColumn("i", F.pmod(F.xxhash64("fp", "tree"), F.col("s")).cast("int"))
    routed = routed.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    routed = routed.select("tree", "leaf", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "fp")

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        a, b = links_within(g["fp"].to_numpy().view(np.uint64), distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return routed.groupBy("tree", "leaf", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def near_duplicate_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4,
                           distance: int = DISTANCE, bands: int = BANDS, **kw) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row: the smallest doc_id among all rows reachable over close fingerprints.

    Null or empty text has fingerprint 0 and is linked like any other. Repeated rows stay and share their class.
    A null id takes no part in the minimum; a class with only null ids has a null component_id. Other columns are
    not read. An empty table gives no rows.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = checkpointed(with_fingerprint(base, size=size, name="fp").drop("text"))
    return rows.join(_classes(rows, distance, bands, **kw), "fp").select("doc_id", "fp", "component_id")


def _classes(rows: DataFrame, distance: int, bands: int, **kw) -> DataFrame:
    """``(fp, component_id)`` for the distinct fingerprints of ``(doc_id, fp)`` rows."""
    fps = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    links = fingerprint_links(fps, distance, bands, **kw)
    labels = connected_components(links).withColumnRenamed("node", "fp")
    named = checkpointed(fps.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp")))
    return named.select("fp", "label").join(named.groupBy("label").agg(F.min("first").alias("component_id")), "label")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4, distance: int = DISTANCE, bands: int = BANDS, **kw) -> DataFrame:
    """The documents without near-duplicates: of each class the row with the smallest doc_id stays, once.

    Classes are those of ``near_duplicate_classes``; texts without words are linked like any other. Ties on the id (or
    classes without any id) are decided by the hash of the row; of fully repeated rows one stays. All columns are
    returned as they came. An empty table gives an empty one.
    """
    cols = docs.columns
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), row_hash(docs).alias("h"))
    rows = checkpointed(with_fingerprint(base, size=size, name="fp").drop("text"))
    rows = checkpointed(rows.join(_classes(rows, distance, bands, **kw).select("fp", "label"), "fp").select("doc_id", "h", "label"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("h"))).alias("w")
    won = checkpointed(rows.groupBy("label").agg(first).select(F.col("w.h").alias("__h"), F.col("w.doc_id").alias("__d")))
    copies = checkpointed(rows.groupBy("h", "doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                          .select(F.col("h").alias("__h"), F.col("doc_id").alias("__d"), F.lit(True).alias("__m")))
    on = lambda l, r: (l["__h"] == r["__h"]) & l["__d"].eqNullSafe(r["__d"])
    marked = won.join(copies, on(won, copies), "left").select(won["__h"], won["__d"], F.coalesce("__m", F.lit(False)).alias("__m"))
    kept = docs.withColumn("__k", row_hash(docs)).join(
        marked, (F.col("__k") == F.col("__h")) & F.col(doc_id).eqNullSafe(F.col("__d")))
    once = kept.where("not __m").select(*cols)
    return once.unionByName(kept.where("__m").dropDuplicates(["__h", "__d"]).select(*cols))
