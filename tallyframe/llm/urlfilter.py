"""URL filters: Bloom filter cascades give exact membership of every key of the corpus, without joins.

The first level holds the listed keys; the next those other keys of the corpus that wrongly pass it, the one after
the listed keys that wrongly pass that, and so on until no key is wrong. Over the key universe it was built on, a
cascade is exact. Bits are set in the tasks and merged by word with an exclusive group per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.session import checkpointed

KEYS_PER_CASCADE = 4_000_000  # keys in a level of one cascade, about 8 MB of bits; longer lists and larger universes take more passes
ONE_WRONG_IN = 200  # keys of the universe that pass a level by mistake (about 1 in 215 by bits and hashes)
BITS_PER_KEY = 12
HASHES = 5
MAX_LEVELS = 64


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def key_hash(key: Column) -> list[Column]:
    return [F.xxhash64(key), F.xxhash64(F.lit("second"), key)]


class Cascade:
    """Levels of bits over 128-bit key hashes; level 0 holds the listed keys, odd levels false positives."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, int]] = []

    @staticmethod
    def positions(h1: np.ndarray, h2: np.ndarray, bits: int, level: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            step = (h2 + np.uint64(2 * level + 1) * h1) | np.uint64(1)
            return np.stack([((h1 ^ (h2 >> np.uint64(level % 32))) + np.uint64(i + 1) * step) % np.uint64(bits) for i in range(HASHES)])

    def passes(self, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        words, bits = self.levels[level]
        p = self.positions(h1, h2, bits, level)
        return ((words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1)).all(axis=0)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Listed or not: decided by the parity of the first level that refuses the key."""
        open_, out = np.ones(len(h1), bool), np.full(len(h1), len(self.levels) % 2 == 1)
        for k in range(len(self.levels)):
            ok = self.passes(k, h1, h2)
            out[open_ & ~ok] = k % 2 == 1
            open_ &= ok
        return out


def _u64(col: pa.Array) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


def build(universe: DataFrame) -> Cascade:
    """``universe``: distinct ``(h1, h2, listed)``; keys of a wrong level are a fraction of the level before."""
    cascade = Cascade()
    sides = {True: universe.where("listed").select("h1", "h2"), False: universe.where("not listed").select("h1", "h2")}
    inside = True
    wrong = sides[True]
    for level in range(MAX_LEVELS):
        n = wrong.count()
        if not n:
            return cascade
        bits = max(64, -(-n * BITS_PER_KEY // 64) * 64)

        def set_bits(batches: Iterator[pa.RecordBatch], bits=bits, level=level) -> Iterator[pa.RecordBatch]:
            words = np.zeros(bits // 64, np.uint64)
            for b in batches:
                p = Cascade.positions(_u64(b.column(0)), _u64(b.column(1)), bits, level).ravel()
                np.bitwise_or.at(words, (p >> np.uint64(6)).astype(np.int64), np.uint64(1) << (p & np.uint64(63)))
            at = np.flatnonzero(words)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at].view(np.int64))], names=["w", "b"])

        got = wrong.mapInArrow(set_bits, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
        words = np.zeros(bits // 64, np.uint64)
        words[got.column(0).to_numpy()] = got.column(1).to_numpy().view(np.uint64)
        cascade.levels.append((words, bits))
        inside = not inside
        sent = universe.sparkSession.sparkContext.broadcast((cascade, len(cascade.levels)))

        def fooled(batches: Iterator[pa.RecordBatch], sent=sent, level=level) -> Iterator[pa.RecordBatch]:
            cascade = sent.value[0]
            for b in batches:
                yield b.filter(pa.array(cascade.passes(level, _u64(b.column(0)), _u64(b.column(1)))))

        sides[inside] = checkpointed(sides[inside].mapInArrow(fooled, "h1 long, h2 long"))
        wrong = sides[inside]
    raise RuntimeError("keys that hash alike on both sides; no cascade can part them")


def flag(rows: DataFrame, listed: DataFrame, hashes: str, name: str, key: str = "key", per_cascade: int = KEYS_PER_CASCADE) -> DataFrame:
    """Adds ``name``: for each key hash in the array ``hashes`` of ``(h1, h2)`` whether the key is listed; exact.

    The universe is all keys of ``rows``. Level 0 grows with the list, level 1 with the universe; if either would have
    more than ``per_cascade`` keys, the universe is split by hash into several cascades, applied one after the other,
    so what is broadcast stays bounded.
    """
    lists = checkpointed(listed.where(F.col(key).isNotNull()).select(*[h.alias(n) for h, n in zip(key_hash(F.col(key)), ("h1", "h2"))]).distinct())
    keys = rows.select(F.explode(hashes).alias("x")).select("x.h1", "x.h2").distinct()
    every = keys.withColumn("listed", F.lit(False)).unionByName(lists.withColumn("listed", F.lit(True)))
    universe = checkpointed(every.groupBy("h1", "h2").agg(F.max("listed").alias("listed")))
    total, listed_keys = universe.agg(F.count(F.lit(1)), F.count_if("listed")).first()
    parts = max(1, -(-max(listed_keys, total // ONE_WRONG_IN) // per_cascade))
    out = rows.withColumn(name, F.transform(hashes, lambda x: F.lit(False)))
    at, to = rows.columns.index(hashes), len(rows.columns)
    for k in range(parts):
        cascade = build(universe.where(F.pmod("h2", F.lit(parts)) == k))
        sent = rows.sparkSession.sparkContext.broadcast(cascade)

        def test(batches: Iterator[pa.RecordBatch], k=k, sent=sent) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lists = b.column(at)
                flat = lists.flatten()
                h1, h2 = _u64(flat.field(0)), _u64(flat.field(1))
                mine = h2.view(np.int64) % parts == k
                old = b.column(to).flatten().to_numpy(zero_copy_only=False).astype(bool)
                new = np.where(mine, sent.value.contains(h1, h2), old)
                sizes = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
                cols = list(b.columns)
                cols[to] = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(new))
                yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

        out = out.mapInArrow(test, out.schema)
        if parts > 1:
            out = checkpointed(out)
    return out


def judge(pages: DataFrame, rules: DataFrame, blocked_hosts: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every page.

    ``rules``: ``(host, path, action)``, action allow or block; a rule fits its host and all subdomains where the
    path starts with its path. The longest (host and path together, then the host) wins; the same rule with both
    actions blocks. Without a rule the verdict is block if the host or a parent domain is in ``blocked_hosts``
    (column ``host``), else allow. Null urls and urls without ``://`` have empty host and path and fit no rule.
    Rules with a null part and null hosts are left out; repeated pages each get a row.
    """
    rules = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())  # bounded by the longest rule
    base = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    labels = F.split("host", "\\.", -1)
    hosts = F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    sizes = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    fits = F.filter(sizes, lambda n: n <= F.length("path"))
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(fits, lambda n: F.struct(h.alias("h"), F.substring(F.col("path"), F.lit(1), n).alias("p")))))
    pair = lambda ks: F.transform(ks, lambda k: F.struct(*[h.alias(n) for h, n in zip(key_hash(k), ("h1", "h2"))]))
    sep = "\x00"
    rows = base.withColumn("__k", keys).withColumns({
        "__r": pair(F.transform("__k", lambda k: F.concat(k["h"], F.lit(sep), k["p"]))), "__d": pair(hosts)})
    rows = checkpointed(rows)
    text = F.concat("host", F.lit(sep), "path").alias("key")
    rows = flag(rows, rules.where("action = 'allow'").select(text), "__r", "__allow")
    rows = flag(rows, rules.where("action = 'block'").select(text), "__r", "__block")
    rows = flag(rows, blocked_hosts.select(F.col("host").alias("key")), "__d", "__bad")
    hits = F.filter(F.transform(F.arrays_zip("__k", "__allow", "__block"), lambda x: F.struct(
        (F.length(x["__k"]["h"]) + F.length(x["__k"]["p"])).alias("n"), F.length(x["__k"]["h"]).alias("m"), x["__block"].alias("b"),
        (x["__allow"] | x["__block"]).alias("hit"), F.concat(x["__k"]["h"], x["__k"]["p"]).alias("rule"))), lambda x: x["hit"])
    rows = rows.withColumn("__best", F.array_max(hits))
    verdict = F.when(F.col("__best").isNotNull(), F.when(F.col("__best.b"), "block").otherwise("allow")).when(
        F.exists("__bad", lambda x: x), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", F.col("__best.rule").alias("rule"), verdict.alias("verdict"))
