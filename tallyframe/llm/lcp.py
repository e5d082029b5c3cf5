"""Document fingerprints by locally consistent parsing.

Each level joins runs, tosses deterministic coins (the lowest bit in which a symbol differs from the one before,
three times over, leaves six labels) and starts a phrase at every local maximum. A phrase's name is a hash of its
symbols, so equal substrings get equal names except within a few symbols of their ends, wherever they stand. The
fingerprint is made of names of levels two and three (about 10 and 40 characters a phrase): all that lie below a
fixed bound, so it grows with the text, and the smallest ``KEPT`` at least, so short texts keep all of theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import shuffle_parallelism

LEVELS = (2, 3)
KEPT = 64  # names a fingerprint has at least, if the text has as many
BOUND = 1 << 29  # every name below it is kept: one in eight
CHARS = 1 << 20  # characters parsed at once
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(1 << 12, _C, np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _coins(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the lowest bit in which a symbol differs from its left neighbour, plus that bit; document starts get 0 or 1."""
    diff = np.empty_like(x)
    diff[0] = 1
    np.bitwise_xor(x[1:], x[:-1], out=diff[1:])
    diff[first] = 1
    low = diff & (~diff + x.dtype.type(1))
    k = np.bitwise_count(low - x.dtype.type(1))
    return (2 * k + ((x & low) != 0)).astype(np.uint8)


def parse_level(sym: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names and their documents from the symbols of many documents, one after the other."""
    n = len(sym)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(doc[1:], doc[:-1], out=new[1:])
    change = new.copy()
    change[1:] |= sym[1:] != sym[:-1]
    at = np.flatnonzero(change)
    if len(at) < n:  # a run is one symbol that knows its length
        length = np.diff(np.append(at, n)).astype(np.uint64)
        sym = np.where(length > 1, _mix(sym[at] + length * _A), sym[at])
        doc, new = doc[at], new[at]
        n = len(at)
    first = np.flatnonzero(new)
    c = _coins(_coins(_coins(sym, first), first), first)
    # neighbours in a document differ except at its start, where a tie is no maximum
    left, right = np.empty(n, np.uint8), np.empty(n, np.uint8)
    left[0], right[-1] = 255, 255
    left[1:], right[:-1] = c[:-1], c[1:]
    right[first[1:] - 1] = 255  # the last symbol of a document is no maximum
    start = (c > left) & (c > right)
    start[first] = True
    begin = np.flatnonzero(start)
    pos = np.arange(n) - np.repeat(begin, np.diff(np.append(begin, n)))
    name = np.add.reduceat(_mix(sym + _A) * _POWERS[pos & 0xFFF], begin)
    return _mix(name), doc[begin]


def fingerprints(texts: list[str]) -> list[np.ndarray]:
    """The distinct 32-bit names of each text below ``BOUND``, and at least its ``KEPT`` smallest, ascending; an empty text has none."""
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
    group: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if t:
            group.append(i)
            size += len(t)
        if group and (size >= CHARS or i == len(texts) - 1):
            _parse(texts, group, out)
            group, size = [], 0
    if group:
        _parse(texts, group, out)
    return out


def _parse(texts: list[str], group: list[int], out: list[np.ndarray]) -> None:
    sizes = np.array([len(texts[i]) for i in group])
    sym = np.frombuffer("".join([texts[i] for i in group]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    doc = np.repeat(np.arange(len(group), dtype=np.int64), sizes)
    found = []
    with np.errstate(over="ignore"):
        for level in range(1, max(LEVELS) + 1):
            sym, doc = parse_level(sym, doc)
            if level in LEVELS:
                found.append((doc << 32) | (sym >> np.uint64(32)).astype(np.int64))
    keys = np.unique(np.concatenate(found))
    owner = keys >> 32
    begin = np.searchsorted(owner, np.arange(len(group)))
    end = np.append(begin[1:], len(keys))
    names = (keys & 0xFFFFFFFF).astype(np.uint32)
    for k, i in enumerate(group):
        mine = names[begin[k]:end[k]]
        out[i] = mine[:max(KEPT, int(np.searchsorted(mine, BOUND)))]


def _reach(names: np.ndarray) -> int:
    """Below this a fingerprint holds every name of its text; one of fewer than ``KEPT`` names holds all."""
    return 1 << 32 if len(names) < KEPT else max(BOUND, int(names[-1]) + 1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of the names as far as both fingerprints hold all of theirs; two empty ones are alike.

    It is exact for two texts of fewer than ``KEPT`` names and else an estimate from all names below the smaller
    reach, one in eight at least.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    reach = min(_reach(a), _reach(b))
    a, b = (x[:np.searchsorted(x, reach)] for x in (a, b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a) + len(b) - both, 1)


def as_hex(names: np.ndarray) -> str:
    return names.astype(">u4").tobytes().hex()


def edited_text(text: str, following: str) -> str:
    """The last third of the text replaced by as many first characters of the following one."""
    m = len(text) // 3
    return text[:len(text) - m] + following[:m]


COLUMNS = ("doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """``(bucket, edge, doc_id, text)`` so that inside a bucket, in order, each row is followed by its next document.

    The order is descending id, null ids last, ties by a hash of the text, descending. Ids are cut at approximate
    quantiles read once; the first row of each bucket is also put at the end of the bucket before (the very first at
    the end of the last). So the texts are shuffled once and no task holds more than a few buckets.
    """
    spark = docs.sparkSession
    n = buckets or 4 * shuffle_parallelism(spark)
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    cuts = base.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    where = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda i, s: F.when(
        F.coalesce(F.try_element_at(bounds, i + s) <= F.col("doc_id"), F.lit(False)), i + s).otherwise(i)) if cuts else F.lit(0)
    base = base.withColumn("bucket", where).withColumn("h", F.xxhash64("text"))
    rank = F.struct(F.col("doc_id").isNotNull().alias("k"), F.col("doc_id"), F.col("h"))
    first = {r["bucket"]: r["m"] for r in base.groupBy("bucket").agg(F.max(rank).alias("m")).collect()}
    order = sorted(first, reverse=True)
    follow = [(order[i - 1], first[b]["doc_id"], first[b]["h"]) for i, b in enumerate(order)]  # a bucket's first row also ends the one before it
    edges = F.broadcast(spark.createDataFrame(follow, "__to int, __d long, __h long"))
    base = base.join(edges, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("h") == F.col("__h")), "left")
    place = F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("e")), F.struct(F.col("__to").alias("b"), F.lit(1).alias("e")))
    base = base.withColumn("x", F.explode(F.filter(place, lambda p: p["b"].isNotNull())))
    return base.select(F.col("x.b").alias("bucket"), F.col("x.e").alias("edge"), "doc_id", "h", "text")


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """Per row its fingerprint, that of its edited text, and their likeness to it and to the next document's.

    Null text counts as empty. A single document follows itself. Repeated rows each get a row. Other columns are
    not read; an empty table gives no rows.
    """
    rows = with_next(docs, doc_id, text, buckets)
    n = shuffle_parallelism(docs.sparkSession)
    rows = rows.repartition(n, "bucket").sortWithinPartitions("bucket", "edge", F.desc_nulls_last("doc_id"), F.desc("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row so far, which still waits for its next

        def emit(chain: list[tuple]) -> Iterator[pa.RecordBatch]:
            """Rows of one bucket in order; all but the last have their next behind them."""
            pairs = [(a, b) for a, b in zip(chain, chain[1:]) if a[0] == b[0] and not a[1]]
            if not pairs:
                return
            edited = [edited_text(a[3], b[3]) for a, b in pairs]
            own = fingerprints([c[3] for c in chain])
            mine = {id(c): f for c, f in zip(chain, own)}
            other = fingerprints(edited)
            fp = [mine[id(a)] for a, _ in pairs]
            nx = [mine[id(b)] for _, b in pairs]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[2] for a, _ in pairs], pa.int64()), pa.array([len(a[3]) for a, _ in pairs], pa.int64()), pa.array(edited, pa.string()),
                 pa.array(map(as_hex, fp), pa.string()), pa.array(map(as_hex, other), pa.string()),
                 pa.array([likeness(a, b) for a, b in zip(fp, other)], pa.float64()), pa.array([likeness(a, b) for a, b in zip(fp, nx)], pa.float64())],
                names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in (0, 1, 2, 4)]
            chain, size = [] if held is None else [held], 0
            for row in zip(*cols):
                chain.append(row)
                size += len(row[3])
                if size >= CHARS:
                    yield from emit(chain)
                    chain, size = [chain[-1]], 0
            yield from emit(chain)
            held = chain[-1] if chain else held

    return rows.select("bucket", "edge", "doc_id", "h", "text").mapInArrow(run, COLUMNS)
