"""Spelling variant grouping: words one edit apart, found by a frontier that walks a trie level by level.

The trie is a table of edges whose labels are the unbranched stretches between nodes, so a junk word of any length is one
edge and the number of levels is the number of branchings on a path, not the number of letters. The frontier is a table of
states (word, position, node, edits). A state without edits starts at its word's own node and climbs towards the root; at
every node it branches into the edges that leave the word's path, which is the one edit (a letter replaced, or a letter
more in the other word; a letter less is the same pair seen from the shorter word). A state with an edit goes down the edge
that carries on its rest; where the rest ends at the end of a word, the two are near.

Two tries are walked at once, of the words and of the words reversed: two near words share their first or their last half,
so each state branches only in the second half of its word, where few edges leave a node. The exact test is the walk itself.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import text_of
from tallyframe.session import checkpointed, shared_path, shuffle_parallelism

LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words shorter than this or seen less often take no part.
MIN_LENGTH, MIN_COUNT = 7, 2
#: One of so many pairs of document and run loses a letter.
SLIP = 31
#: A form is at least so many times as frequent as its variant.
RATIO = 10
#: Letters that all words below one root share; half of MIN_LENGTH, so that no state branches above it.
ROOT = MIN_LENGTH // 2

EDGES = pa.schema([("d", pa.int32()), ("parent", pa.string()), ("label", pa.string()), ("child", pa.string()), ("ends", pa.bool_()),
                   ("firsts", pa.string())])


def word_counts(docs: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """``(word, n)``: the words of all texts with their occurrences.

    A null text has no words; a null id counts as the empty text in the hash. Repeated rows count as often as they are
    there. Other columns are not looked at.
    """
    runs = F.regexp_extract_all(F.translate(text_of(text), UPPER, LOWER), F.lit(f"{LETTERS}{{{MIN_LENGTH},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col(id_).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    runs = runs.select("run", h.alias("h"))
    at = F.col("h") % F.length("run")
    kept = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", (at + 2).cast("int"), F.length("run")))
    words = runs.select(F.when(F.col("h") % SLIP == 0, kept).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT)


def _trie(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the tries of sorted words, each below its first letters; holds one path of nodes at a time."""
    out: list[tuple] = []
    path: list[list] = []  # nodes from the root: [text, is a word, first letters of its edges]
    at, last = None, ""

    def climb(depth: int) -> None:
        while len(path) > 1 and len(path[-1][0]) > depth:
            text, ends, firsts = path.pop()
            if len(path[-1][0]) < depth:
                path.append([text[:depth], False, ""])
            up = path[-1]
            label = text[len(up[0]):]
            up[2] += label[0]
            out.append((at[0], up[0], label, text, ends, firsts))

    def table() -> pa.RecordBatch:
        rows = [pa.array([r[i] for r in out], EDGES.field(i).type) for i in range(len(EDGES))]
        out.clear()
        return pa.RecordBatch.from_arrays(rows, schema=EDGES)

    for b in batches:
        for d, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if (d, s[:ROOT]) != at:
                climb(0)
                at, last = (d, s[:ROOT]), s[:ROOT]
                path[:] = [[last, False, ""]]
            climb(len(os.path.commonprefix([last, s])))
            path.append([s, True, ""])
            last = s
            if len(out) >= 20000:
                yield table()
    climb(0)
    if out:
        yield table()


def edge_table(keys: DataFrame) -> DataFrame:
    """``(d, parent, label, child, ends, firsts)`` of the words ``s`` of trie ``d``; ``firsts`` are the letters that go on from the child."""
    sorted_ = keys.select("d", "s").repartition(shuffle_parallelism(keys.sparkSession), "d", F.substring("s", 1, ROOT)).sortWithinPartitions("d", "s")
    return sorted_.mapInArrow(_trie, "d int, parent string, label string, child string, ends boolean, firsts string")


def _rest(word: Column | str, at: Column) -> Column:
    return F.substring(word, (at + 1).cast("int"), F.length(word))


def _arrive(walk: DataFrame) -> DataFrame:
    """States that went down an edge: those whose rest goes on below the child, or ends there with a word."""
    rest = F.col("rest")
    alive = F.when(rest == "", F.col("ends")).otherwise(F.contains(F.col("firsts"), F.substring(rest, 1, 1)))
    return walk.where(alive).select("d", "word", "child", "rest", F.lit(1).alias("edits")).withColumnRenamed("child", "node")


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, b)``, a before b: all pairs of distinct words that differ by one inserted, deleted or replaced code point.

    ``words`` has distinct ``word`` values of MIN_LENGTH letters or more. No words give no pairs. The levels end when no state is left.
    """
    spark = words.sparkSession
    keys = words.select(F.explode(F.array(F.struct(F.lit(0).alias("d"), F.col("word").alias("s")),
                                          F.struct(F.lit(1).alias("d"), F.reverse("word").alias("s")))).alias("k")).select("k.*")
    edges = _Edges(edge_table(keys))
    found = []
    half = lambda node: F.length(node) >= F.floor((F.length("word") + F.col("d")) / 2)  # the last half of a reversed word is the longer one
    at = lambda frame, node: frame.select("d", "word", F.col(node).alias("node"), F.lit("").alias("rest"), F.lit(0).alias("edits"))
    words_in = edges.all.where("ends").withColumn("word", F.col("child"))
    # a word's own node matters where edges leave it; its parent is known from the edge
    states = at(words_in.where("firsts <> ''"), "child").unionByName(at(words_in.where(half("parent")), "parent"))
    try:
        while True:
            still, edited = states.where("edits = 0"), states.where("edits = 1 and rest <> ''")
            depth = F.length("node")
            own = F.substring("word", (depth + 1).cast("int"), F.lit(1))
            first = F.substring("label", 1, 1)
            leave = still.join(edges.down, ["d", "node"]).where(first != own)
            # the edge's letter instead of the word's (each pair from its smaller letter), or before it
            rests = F.array_compact(F.array(F.when((own != "") & (first > own), _rest("word", depth + 1)), _rest("word", depth)))
            tail = F.substring("label", F.lit(2), F.length("label"))
            leave = leave.select("d", "word", "child", "ends", "firsts", tail.alias("tail"), F.explode(rests).alias("rest"))
            leave = leave.where(F.startswith("rest", "tail")).withColumn("rest", _rest("rest", F.length("tail")))
            go = edited.withColumn("first", F.substring("rest", 1, 1)).join(edges.down.withColumn("first", first), ["d", "node", "first"])
            go = go.where(F.startswith("rest", "label")).withColumn("rest", _rest("rest", F.length("label")))
            climb = at(still.where("node <> word").join(edges.up, ["d", "node"]).where(half("parent")), "parent")
            states = checkpointed(climb.unionByName(_arrive(leave)).unionByName(_arrive(go)))
            found.append(states.where("edits = 1 and rest = ''").select("d", "word", "node"))
            if states.where("edits = 0 or rest <> ''").isEmpty():
                break
    finally:
        edges.forget(spark)
    pairs = found[0]
    for f in found[1:]:
        pairs = pairs.unionByName(f)
    back = lambda c: F.when(F.col("d") == 1, F.reverse(c)).otherwise(F.col(c))
    return pairs.select(F.least(back("word"), back("node")).alias("a"), F.greatest(back("word"), back("node")).alias("b")).distinct()


class _Edges:
    """The edge table, written once bucketed by each end, so that the levels shuffle only their states."""

    def __init__(self, edges: DataFrame):
        spark = edges.sparkSession
        self.all = edges = checkpointed(edges)
        self.names = []
        self.down = self._keep(spark, edges.withColumnRenamed("parent", "node"), ["d", "node", "label", "child", "ends", "firsts"])
        self.up = self._keep(spark, edges.withColumnRenamed("child", "node"), ["d", "node", "parent"])

    def _keep(self, spark, edges: DataFrame, columns: list[str]) -> DataFrame:
        name = f"trie_{uuid.uuid4().hex}"
        n = shuffle_parallelism(spark)
        edges.select(columns).repartition(n, "d", "node").write.bucketBy(n, "d", "node").sortBy("d", "node").option(
            "path", shared_path(spark, "trie")).saveAsTable(name)
        self.names.append(name)
        return spark.table(name)

    def forget(self, spark) -> None:
        """Takes the names out of the catalog; the files stay in the shared folder like other steps."""
        for n in self.names:
            spark.sql(f"drop table if exists {n}")


def variants(docs: DataFrame, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)``, one row per word of the texts.

    ``form`` is the most frequent near word (ties: the smallest in code-point order) where it is RATIO times as frequent,
    ``root`` the last of the chain of forms. A table without words, or an empty one, gives no rows. Null texts, repeated rows
    and ids as in ``word_counts``.
    """
    words = checkpointed(word_counts(docs, text, id_))
    pairs = checkpointed(near_pairs(words))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    n_of = words.select(F.col("word").alias("b"), "n")
    near = both.join(n_of, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), F.col("b").alias("w"))).alias("best"))
    best_n = -F.col("best.m")
    out = words.join(near, "word", "left")
    chosen = best_n >= RATIO * F.col("n")
    out = checkpointed(out.select("word", F.when(chosen, F.col("best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                  F.when(chosen, best_n).alias("form_n")))
    roots = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:  # pointers double; n grows along a chain, so it has no cycle
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = checkpointed(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            break
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
