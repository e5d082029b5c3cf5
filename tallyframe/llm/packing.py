"""Packing documents into fixed sequences: cutting-stock patterns by column generation, assigned to ranked pieces.

Lengths are rounded up to units, so the linear program has one row per unit length whatever the corpus, and what
the driver holds is a histogram of that many bins. Dynamic programming over the unit lengths prices new patterns.
Whole pattern counts are kept, the remainder is solved again, and the last few pieces are placed first-fit
decreasing. Pieces of one unit length are numbered by a distributed rank and take the pattern slots of their number.
"""

from __future__ import annotations

import gc
import os
import string
import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.session import checkpointed, shuffle_parallelism

CAPACITY = 2048
UNIT = 16
LEAST_GAP = 2  # units of room in a sequence that are worth a cut
ROUNDING = 0.02  # share of the tokens that may be lost to whole units; beyond it lengths are rounded by their size
FINE, FINE_GAP = 6, 16  # lengths up to 2^FINE exact, then half as many steps an octave; tokens of room worth a cut
END_ID = 1
CACHE = 600_000  # entries kept by a worker
CHARS = 1 << 20  # characters split at once
CLOSING = "".join(set(string.punctuation) - set("'<|>"))  # no part of contractions and special tokens


class _Ids:
    """Little-endian ids of texts, looked up by space-delimited chunk.

    The vocabulary's model never joins text across white space, nor letters with the punctuation behind them, and
    lower-cases. So chunks that differ in case or closing punctuation share the ids of their letters, and only
    letters not seen before reach the tokenizer, many in one string. What a chunk is made of is a chunk itself, so one
    table holds both.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.whole = Tokenizer.from_file(path)
        # lower-case letters in composed form need neither the normalizer nor the splitting pattern
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.letters.get_vocab()
        self.last = np.zeros(max(vocab.values(), default=0) + 1, bool)  # ids that end a word
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.chunks: dict[str, bytes] = {}

    def forget(self) -> None:
        self.chunks = {}

    def _learn(self, chunks: list[str], tokenizer) -> None:
        for c, e in zip(chunks, tokenizer.encode_batch_fast(chunks, add_special_tokens=False)):
            self.chunks[c] = np.array(e.ids, "<u4").tobytes()

    def _learn_words(self, words: list[str]) -> None:
        """Ids of words of letters; every word ends with the only id of its own that ends words."""
        if not words:
            return
        ids = np.array(self.letters.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
        if len(ends) != len(words):  # a vocabulary without marks of the end
            self._learn(words, self.letters)
            return
        ids = ids.tobytes()
        self.chunks.update(zip(words, [ids[i:j] for i, j in zip([0, *ends], ends)]))

    def encode(self, texts: list[str]) -> list[bytes]:
        gc.disable()  # many small objects, no cycles
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.chunks) > CACHE:
            self.chunks.clear()
        chunks, cut = self.chunks, []
        words, other = set(), set()
        for c in set(filterfalse(chunks.__contains__, chain.from_iterable(split))):
            letters = c.rstrip(CLOSING)
            low = letters.lower()
            # a capital sigma is lower-cased by its place in a word, so it is left to the tokenizer
            if letters.isalpha() and (letters.isascii() or "\u03a3" not in letters and low.isalpha() and is_normalized("NFC", low)):
                if low not in chunks:
                    words.add(low)
                if low != c:
                    rest = c[len(letters):]
                    if rest not in chunks:
                        other.add(rest)
                    cut.append((c, low, rest))
            else:
                other.add(c)
        self._learn_words(list(words))
        self._learn(list(other), self.whole)
        chunks.update([(c, chunks[low] + chunks[rest]) for c, low, rest in cut])
        get = chunks.__getitem__
        return [b"".join(map(get, s)) for s in split]


_TOKENIZERS: dict[str, _Ids] = {}


def token_bytes(texts: list[str], path: str) -> Iterator[bytes]:
    """Ids of whole texts as little-endian 32-bit numbers, equal to encoding each in one call."""
    ids = _TOKENIZERS.get(path)
    if ids is None:
        ids = _TOKENIZERS[path] = _Ids(path)
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= CHARS:
            yield from ids.encode(group)
            group, size = [], 0
    if group:
        yield from ids.encode(group)


def cut_pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
               with_ids: bool = True) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, ids_crc32[, ids])``: each document's ids and the closing id, cut at the capacity.

    A null or empty text is the closing id alone. Null and repeated ids are kept. Other columns are not read.
    """
    size = 4 * capacity
    end = int(END_ID).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from cut(batches)
        finally:
            if path in _TOKENIZERS:  # the worker may serve other stages next; only the tokenizer is worth its memory
                _TOKENIZERS[path].forget()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, start, ids, total = [], [], [], []
            for i, b in enumerate(token_bytes(["" if t is None else t for t in batch.column(1).to_pylist()], path)):
                b += end
                for at in range(0, len(b), size):
                    owners.append(i)
                    start.append(at // 4)
                    ids.append(b[at:at + size])
                    total.append(len(b) // 4)
            cols = [batch.column(0).take(pa.array(owners, pa.int64())), pa.array(start, pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(total, pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64())]
            names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return base.mapInArrow(run, schema)


def _knapsack(value: np.ndarray, size: np.ndarray, cap: int) -> tuple[float, np.ndarray]:
    """Best unbounded filling; sizes ascending."""
    best, pick = np.zeros(cap + 1), np.full(cap + 1, -1)
    upto = np.searchsorted(size, np.arange(cap + 1), side="right")
    for c in range(1, cap + 1):
        best[c], pick[c] = best[c - 1], -1
        k = upto[c]
        if k:
            cand = best[c - size[:k]] + value[:k]
            j = int(cand.argmax())
            if cand[j] > best[c] + 1e-12:
                best[c], pick[c] = cand[j], j
    pattern, c = np.zeros(len(size)), cap
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            pattern[pick[c]] += 1
            c -= size[pick[c]]
    return float(best[cap]), pattern


def solve_patterns(size: np.ndarray, demand: np.ndarray, cap: int, gap: float = 1e-3, rounds: int = 6000) -> tuple[np.ndarray, np.ndarray]:
    """Column generation for the cutting-stock program: ``(patterns, counts)`` with counts >= 0, fractional.

    Revised simplex from one-length patterns; among equal ratios the largest pivot leaves, which gets over the many
    ties. Each pricing also gives a lower bound, and within ``gap`` of it the work ends. Stopping early still gives
    a valid covering, only a looser one.
    """
    m = len(size)
    basis = np.diag((cap // size).astype(float))
    cost, inv = np.ones(m), np.diag(1 / np.diag(basis))
    x, bound = inv @ demand, float(size @ demand) / cap
    for step in range(rounds):
        if step % 100 == 99:
            # one Newton step against rounding; einsum, as a threaded BLAS can stall beside the driver's JVM
            inv = 2 * inv - np.einsum("ij,jk->ik", np.einsum("ij,jk->ik", inv, basis), inv)
            x = np.maximum(inv @ demand, 0)
        if float(cost @ x) <= bound * (1 + gap):
            break
        dual, price = cost @ inv, 1.0
        worst = int(dual.argmin())
        if dual[worst] < -1e-9:  # cheaper to let this length be covered too often
            col, price = np.zeros(m), 0.0
            col[worst] = -1.0
        else:
            value, col = _knapsack(dual, size, cap)
            if value <= 1 + 1e-7:
                break
            bound = max(bound, float(dual @ demand) / value)
        d = inv @ col
        ok = d > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, x / np.where(ok, d, 1), np.inf)
        ties = np.flatnonzero(ratio <= ratio.min() + 1e-9)
        r = int(ties[d[ties].argmax()])
        theta = ratio[r]
        x = np.maximum(x - theta * d, 0)
        x[r] = theta
        basis[:, r], cost[r] = col, price
        row = inv[r] / d[r]
        inv = inv - np.outer(d, row)
        inv[r] = row
    real = cost > 0
    return np.rint(basis[:, real].T).astype(int), x[real]


def plan_patterns(counts: dict[int, int], cap: int) -> list[tuple[dict[int, int], int]]:
    """Unit length -> number of pieces to ``(pattern, times)``; together they have a slot for every piece."""
    left = {s: n for s, n in sorted(counts.items()) if n > 0}
    plan: list[tuple[dict[int, int], int]] = []

    def take(pattern: dict[int, int], times: int) -> None:
        plan.append((pattern, times))
        for s, k in pattern.items():
            left[s] = max(0, left[s] - k * times)
            if not left[s]:
                del left[s]

    while left:
        size = np.array(sorted(left))
        pats, x = solve_patterns(size, np.array([left[s] for s in size], float), cap)
        before = sum(left.values())
        for i in np.argsort(-x):
            pattern = {int(s): int(k) for s, k in zip(size, pats[i]) if k}
            fits = min((left.get(s, 0) // k for s, k in pattern.items()), default=0)
            times = min(int(np.floor(x[i] + 1e-6)) or int(x[i] >= 0.5), fits)
            if times > 0:
                take(pattern, times)
        if sum(left.values()) > 0.9 * before:
            break
    while left:  # first-fit decreasing, one sequence after the other
        room, pattern = cap, {}
        for s in sorted(left, reverse=True):
            k = min(left[s], room // s)
            if k:
                pattern[s], room = k, room - k * s
        take(pattern, min(left[s] // k for s, k in pattern.items()))
    return plan


def split_plan(plan: list[tuple[dict[int, int], int]], cap: int, least: int = LEAST_GAP) -> tuple[list, int]:
    """Gives up the sequences with most room until what stood in them fills the room (of ``least`` units or more) of the rest.

    Returns the kept ``(pattern, times)`` and the units of room they offer to pieces that are cut.
    """
    room = lambda p: cap - sum(s * k for s, k in p.items())
    kept = sorted(((dict(p), t) for p, t in plan), key=lambda x: room(x[0]))
    gap = sum(room(p) * t for p, t in kept if room(p) >= least)
    given = 0
    while kept and gap > given:
        pattern, times = kept[-1]
        w = room(pattern)
        if w < least:
            break
        n = min(times, max(1, -(-(gap - given) // cap)))  # a sequence given up adds its pieces and takes away its room
        gap, given = gap - n * w, given + n * (cap - w)
        kept[-1] = (pattern, times - n)
        if times == n:
            kept.pop()
    return kept, gap


def slot_table(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """``(unit, first_rank, end_rank, first_sequence, slots_per_sequence)`` rows of a plan; ranks start at 0."""
    used, rows, seq = {}, [], 0
    for pattern, times in plan:
        for s, k in pattern.items():
            a = used.get(s, 0)
            used[s] = a + k * times
            rows.append((s, a, a + k * times, seq, k))
        seq += times
    return rows


def gap_table(plan: list[tuple[dict[int, int], int]], cut_units: int, cap: int, least: int = LEAST_GAP) -> list[tuple[int, int, int, int]]:
    """``(from, width, times, first_sequence)``: the room of the kept sequences as stretches of one line, then fresh sequences."""
    rows, at, seq = [], 0, 0
    for pattern, times in plan:
        w = cap - sum(s * k for s, k in pattern.items())
        if w >= least:
            rows.append((at, w, times, seq))
            at += w * times
        seq += times
    if cut_units > at:
        rows.append((at, cap, -(-(cut_units - at) // cap), seq))
    return rows


def units_of(lengths: dict[int, int], unit: int = UNIT, most: float = ROUNDING) -> int:
    """``unit`` where rounding the lengths of a histogram up to it loses at most that share of the tokens, else 1."""
    tokens = sum(n * k for n, k in lengths.items())
    lost = sum((-n % unit) * k for n, k in lengths.items())
    return unit if lost <= most * tokens else 1


def place(pieces: DataFrame, capacity: int = CAPACITY, unit: int | None = None) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset)`` of pieces with their ``ids``.

    Ranks inside one unit length are counted in hash buckets, so equal lengths of a third of all rows spread over
    the tasks. Where whole pieces leave much room (many pieces of one awkward length), the last ranks of each length
    are laid end to end and cut to fill it; only their ids are carried along. Without a ``unit`` it is UNIT, or, where
    short pieces would lose more than ROUNDING of the tokens to it, one token: lengths are then rounded up by at most a
    32nd of their octave, so the program keeps some two hundred lengths. The tables of slots and of room have
    at most (capacity/unit)^2 rows plus the last few sequences, whatever the corpus, so they are broadcast or
    literal. A sequence has at most ``capacity`` pieces. No pieces give no rows.
    """
    spark = pieces.sparkSession
    if unit is None:
        unit = units_of({r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()})  # at most ``capacity`` rows
    cap, least = capacity // unit, LEAST_GAP if unit > 1 else FINE_GAP
    octave = F.length(F.bin(F.col("length") - 1))
    step = F.pow(F.lit(2), F.greatest(octave - FINE, F.lit(0)))
    units = F.ceil(F.col("length") / unit) if unit > 1 else F.least(F.ceil(F.col("length") / step) * step, F.lit(capacity))
    salts = max(16, shuffle_parallelism(spark))
    p = pieces.withColumn("__u", units.cast("int")).withColumn(
        "__s", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    per = checkpointed(p.groupBy("__u", "__s").agg(F.count(F.lit(1)).alias("__n")))
    counts = {r["__u"]: r["n"] for r in per.groupBy("__u").agg(F.sum("__n").alias("n")).collect()}
    kept, _ = split_plan(plan_patterns(counts, cap), cap, least)
    slots = slot_table(kept)
    whole = {u: min(n, max((e for v, _, e, _, _ in slots if v == u), default=0)) for u, n in counts.items()}
    line, at = [], 0
    for u, n in sorted(counts.items()):
        line.append((u, whole[u], at))
        at += u * (n - whole[u])
    gaps = gap_table(kept, at, cap, least)
    before = W.partitionBy("__u").orderBy("__s").rowsBetween(W.unboundedPreceding, -1)
    limits = F.broadcast(spark.createDataFrame(line, "__u int, __whole long, __line long"))
    base = checkpointed(per.join(limits, "__u").withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))))
    first = {r["__u"]: r["s"] for r in base.where(F.col("__base") + F.col("__n") > F.col("__whole")).groupBy("__u").agg(F.min("__s").alias("s")).collect()}
    cut_from = F.create_map(*[F.lit(x) for kv in first.items() for x in kv]) if first else F.create_map().cast("map<int,int>")
    p = p.withColumn("ids", F.when(F.col("__s") >= F.try_element_at(cut_from, F.col("__u")), F.col("ids")))
    local = W.partitionBy("__u", "__s").orderBy("doc_id", "start", "ids_crc32", "length")
    p = p.withColumn("__r", F.row_number().over(local) - 1).join(base.drop("__n"), ["__u", "__s"]).withColumn("__r", F.col("__r") + F.col("__base"))

    table = F.broadcast(spark.createDataFrame(slots, "__v int, __a long, __e long, __q long, __k long"))
    stays = p.where(F.col("__r") < F.col("__whole")).join(
        table, (F.col("__u") == F.col("__v")) & (F.col("__r") >= F.col("__a")) & (F.col("__r") < F.col("__e")))
    stays = stays.select("doc_id", "start", "length", "doc_tokens", "ids_crc32", F.lit(0).alias("__part"), (-F.col("__u")).alias("__u"), "__r",
                         (F.col("__q") + F.floor((F.col("__r") - F.col("__a")) / F.col("__k"))).cast("long").alias("sequence_id"))
    out = stays
    if gaps:
        room = F.array(*[F.struct(*[F.lit(x).cast("long").alias(n) for x, n in zip(g, "fwtq")]) for g in gaps])
        a, end = F.col("__x"), F.col("__x") + F.col("__u")
        touched = F.filter(room, lambda g: (g["f"] < end) & (g["f"] + g["w"] * g["t"] > a))
        parts = F.flatten(F.transform(touched, lambda g: F.transform(
            F.sequence(F.floor((F.greatest(a, g["f"]) - g["f"]) / g["w"]).cast("long"), F.floor((F.least(end, g["f"] + g["w"] * g["t"]) - 1 - g["f"]) / g["w"]).cast("long")),
            lambda j: F.struct((F.greatest(a, g["f"] + j * g["w"]) - a).alias("lo"), (F.least(end, g["f"] + (j + 1) * g["w"]) - a).alias("hi"), (g["q"] + j).alias("q")))))
        cut = p.where(F.col("__r") >= F.col("__whole")).withColumn("__x", F.col("__line") + (F.col("__r") - F.col("__whole")) * F.col("__u"))
        cut = cut.withColumn("__c", F.explode(parts)).withColumn("__n", F.least(F.col("length"), F.col("__c.hi") * unit) - F.col("__c.lo") * unit).where("__n > 0")
        bytes_ = F.substring(F.col("ids"), (F.col("__c.lo") * (4 * unit) + 1).cast("int"), (F.col("__n") * 4).cast("int"))
        out = stays.unionByName(cut.select(
            "doc_id", (F.col("start") + F.col("__c.lo") * unit).alias("start"), F.col("__n").alias("length"), "doc_tokens", F.crc32(bytes_).alias("ids_crc32"),
            F.lit(1).alias("__part"), (-F.col("__u")).alias("__u"), "__r", F.col("__c.q").alias("sequence_id")))
    inside = W.partitionBy("sequence_id").orderBy("__part", "__u", "__r", "start").rowsBetween(W.unboundedPreceding, -1)
    return out.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")).select(
        "doc_id", "start", "length", "doc_tokens", "ids_crc32", "sequence_id", "offset")


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, unit: int | None = None) -> DataFrame:
    """``(doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset)`` per piece; the ids are written once to the shared folder."""
    return place(checkpointed(cut_pieces(docs, path, doc_id, text, capacity)), capacity, unit)
