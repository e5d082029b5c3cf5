"""Sharding by histogram sort: exact byte counts below candidate boundaries, refined until the splitters fit, one exchange.

The key is the hash of the text, then of the id, so equal texts lie together and even a text that fills a third of
the rows can be cut. Candidate boundaries are prefixes of the key; only those that hold a splitter or too much are
refined, eight bits a round. Counts are summed in the tasks, so a round sends a few thousand numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.session import checkpointed

SHARDS = 16
TOLERANCE = 0.001  # of a shard's bytes
SHIFTS = (51, 43, 35, 27, 19, 11, 3, 0)
PIECES = 1024  # no numbering task gets more than about this share of the bytes or rows


def sort_key(text: Column, doc_id: Column) -> Column:
    """Non-negative long: 31 bits of the text's hash, then 32 of the id's."""
    high = F.shiftrightunsigned(F.xxhash64(text), 33)
    return F.shiftleft(high, 32).bitwiseOR(F.xxhash64(doc_id).bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))


@dataclass
class Histogram:
    """Key ranges in order: ``(low, bytes, rows)``; ``open_at`` has the refined prefixes of each shift."""

    ranges: list[tuple[int, int, int]]
    open_at: dict[int, list[int]]

    def low(self, key: Column) -> Column:
        """The low end of the range a key lies in."""
        cut = lambda s: F.shiftleft(F.shiftright(key, s), s)
        out = cut(SHIFTS[len(self.open_at)])
        for s in reversed(SHIFTS[:len(self.open_at)]):
            out = F.when(F.shiftright(key, s).isin(self.open_at[s]), out).otherwise(cut(s))
        return out


def histogram(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, pieces: int = PIECES) -> Histogram:
    """Counts ``(key, size)`` rows in ever finer ranges until every splitter can be set within the tolerance."""
    count = lambda df, s: {r["p"]: (r["b"], r["n"]) for r in df.groupBy(F.shiftright("key", s).alias("p")).agg(
        F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()}
    done: list[tuple[int, int, int]] = []
    now, opened = count(keys, SHIFTS[0]), {}
    total, rows = sum(b for b, _ in now.values()), sum(n for _, n in now.values())
    slack = tolerance * total / shards
    for s, finer in zip(SHIFTS, SHIFTS[1:]):
        order = sorted([(lo, b) for lo, b, _ in done] + [(p << s, b) for p, (b, _) in now.items()])
        before, at = {}, 0
        for lo, b in order:
            before[lo] = at
            at += b
        inside = lambda a, b: any(a + slack < i * total / shards < a + b - slack for i in range(1, shards))
        heavy = sorted(p for p, (b, n) in now.items() if b > total / pieces or n > rows / pieces or inside(before[p << s], b))
        heavy = [p for p in heavy if now[p][1] > 1]
        if not heavy:
            break
        opened[s] = heavy
        done += [(p << s, *v) for p, v in now.items() if p not in set(heavy)]
        now = count(keys.where(F.shiftright("key", s).isin(heavy)), finer)
    last = SHIFTS[len(opened)]
    return Histogram(sorted(done + [(p << last, *v) for p, v in now.items()]), opened)


def splitters(h: Histogram, shards: int = SHARDS) -> list[tuple[int, int, int]]:
    """``(low, shard, first slot)`` of every range: shard i ends at the range boundary nearest to its share of the bytes."""
    total, at, out, slots = sum(b for _, b, _ in h.ranges), 0, [], [0] * shards
    for low, b, n in h.ranges:
        middle = at + b / 2
        shard = min(shards - 1, int(middle * shards / total)) if total else 0
        out.append((low, shard, slots[shard]))
        slots[shard] += n
        at += b
    return out


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", tolerance: float = TOLERANCE) -> DataFrame:
    """Adds ``__size`` (UTF-8 bytes and one), ``__shard`` and ``__slot`` to the documents, balanced by bytes.

    Null text has size 1. Rows alike in text and id share a key and stay together; a null id is one more id. The
    table of ranges is bounded by the settings (a few thousand rows), so it is broadcast. No documents, no rows.
    """
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long") + 1
    key = sort_key(F.coalesce(F.col(text).cast("string"), F.lit("")), F.col(doc_id).cast("string"))
    h = histogram(checkpointed(docs.select(key.alias("key"), size.alias("size"))), shards, tolerance)
    spark = docs.sparkSession
    table = F.broadcast(spark.createDataFrame(splitters(h, shards), "__l long, __shard int, __first long"))
    rows = docs.withColumns({"__key": key, "__size": size}).withColumn("__low", h.low(F.col("__key")))
    local = W.partitionBy("__low").orderBy("__key", F.col(doc_id), F.col("__size"))
    rows = rows.withColumn("__r", F.row_number().over(local)).join(table, F.col("__low") == F.col("__l"))
    return rows.withColumn("__slot", (F.col("__first") + F.col("__r") - 1).cast("long")).drop("__key", "__low", "__l", "__first", "__r")
