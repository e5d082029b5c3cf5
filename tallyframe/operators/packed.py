"""Searches from all nodes of a graph that fits a task as two integer arrays.

The edges go to every task as a broadcast, like the small side of a broadcast join, and the sources are divided among the
tasks. A task searches from a block of sources at once and hands on one row per node for all its blocks, so that nothing is
shuffled between the levels and no table of (source, node) is written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most edges that travel with the tasks: 8 bytes an edge in a task, 16 on the driver, which hands them out.
PACKED_EDGES = 1 << 23
#: Numbers of 8 bytes that a table of a block of sources by rows holds; a search keeps two or four such tables.
BLOCK_CELLS = 1 << 22
#: Sources whose paths are counted at once.
COLUMNS = 32
#: Nodes with more neighbours than this are worked through one by one, the others in columns of first, second ... neighbours.
HUB = 64


class Packed(NamedTuple):
    """A graph whose nodes with the same one or two edges share a row, as they have the same paths to all others.

    Rows are numbered by falling degree; the neighbours of row i are ``adj[ptr[i]:ptr[i + 1]]``, ascending. Node k, called
    ``names[k]``, is in ``row[k]``; ``many`` has the nodes of each row and ``ends`` the edges of each of these nodes.
    """
    names: pa.Array
    row: np.ndarray
    many: np.ndarray
    ends: np.ndarray
    ptr: np.ndarray
    adj: np.ndarray


def pack(edges: DataFrame, most: int, parallel: bool = False) -> Packed | None:
    """The edges ``(u, v)`` as arrays, without loops and, unless ``parallel``, each pair of nodes once; None for more than ``most``
    edges or where one end only is null."""
    whole = F.col("u").isNotNull() & F.col("v").isNotNull()
    pairs = edges.where(whole & (F.col("u") != F.col("v"))).select("u", "v")
    if not edges.where(F.col("u").isNull() != F.col("v").isNull()).isEmpty() or pairs.count() > most:
        return None
    return pack_arrays(pairs.toArrow(), parallel)


def pack_arrays(t: pa.Table, parallel: bool = False) -> Packed:
    names = pa.chunked_array([*t["u"].chunks, *t["v"].chunks], t.schema.field("u").type).combine_chunks().dictionary_encode()
    n, code = len(names.dictionary), names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    a, b = code[:len(t)], code[len(t):]
    pair = np.concatenate([a * n + b, b * n + a])
    pair = np.sort(pair) if parallel else np.unique(pair)
    a, b = pair // max(n, 1), pair % max(n, 1)
    ends = np.bincount(a, minlength=n)
    last = np.cumsum(ends)
    few = np.flatnonzero(ends <= 2)
    alike = np.arange(n) - n  # below all keys
    alike[few] = (b[last[few] - ends[few]] * n + b[last[few] - 1]) * 2 + ends[few]
    _, first, row = np.unique(alike, return_index=True, return_inverse=True)
    one = np.zeros(n, bool)
    one[first] = True  # one node stands for its row: the others have the same neighbours
    keep = one[a] & one[b]
    a, b, r = row[a[keep]], row[b[keep]], len(first)
    order = np.argsort(-np.bincount(a, minlength=r), kind="stable")
    rank = np.empty(r, np.int64)
    rank[order] = np.arange(r)
    pair = np.sort(rank[a] * r + rank[b])
    ptr = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.bincount(pair // max(r, 1), minlength=r))])
    row = rank[row]
    return Packed(names.dictionary, row.astype(np.int32), np.bincount(row, minlength=r), ends[first[order]], ptr, (pair % max(r, 1)).astype(np.int32))


def components(g: Packed) -> np.ndarray:
    """The smallest row in each row's component."""
    label, starts = np.arange(len(g.many)), g.ptr[:-1]  # every row has a neighbour
    while len(label):
        low = np.minimum(label, np.minimum.reduceat(label[g.adj], starts))
        np.minimum.at(low, label, low.copy())  # the node a label names follows too
        low = low[low]
        if (low == label).all():
            break
        label = low
    return label


def in_blocks(g: Packed, asked: np.ndarray, size: int, alike: bool) -> list[np.ndarray]:
    """The rows with asked nodes (``asked``: how many) in blocks of at most ``size``, with ``alike`` of one number of asked nodes each.

    Rows with the same largest neighbours come together: a block then reaches fewer rows on its first levels.
    """
    rows = np.flatnonzero(asked)
    rows = rows[np.lexsort((g.adj[g.ptr[rows + 1] - 1], g.adj[g.ptr[rows]], asked[rows] if alike else np.zeros(len(rows))))]
    cuts = np.flatnonzero(np.diff(asked[rows])) + 1 if alike else []
    return [x[i:i + size] for x in np.split(rows, cuts) for i in range(0, len(x), size)]


def _marked(g: Packed, deg: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Marks of the neighbours of the marked rows."""
    out = np.zeros(len(deg), bool)
    if rows.any():
        out[g.adj[np.repeat(rows, deg)]] = True
    return out


def _gathered(g: Packed, deg: np.ndarray, values: np.ndarray, rows: np.ndarray, add: np.ufunc) -> Iterator[tuple[slice, np.ndarray]]:
    """For each of the rows (ascending, so their degrees fall) the values of its neighbours, added up; by slices that fit a cache."""
    width, deg, hubs = values.shape[1], deg[rows], int((deg[rows] > HUB).sum())
    part = max(HUB, (1 << 14) // width)
    out, buf = np.empty((part, width), values.dtype), np.empty((part, width), values.dtype)
    for i, x in enumerate(rows[:hubs]):
        out[0] = 0
        for s in range(g.ptr[x], g.ptr[x + 1], part):
            few = g.adj[s:min(s + part, g.ptr[x + 1])]
            np.take(values, few, axis=0, out=buf[:len(few)], mode="clip")
            out[0] = add(out[0], add.reduce(buf[:len(few)], axis=0))
        yield slice(i, i + 1), out[:1]
    for s in range(hubs, len(rows), part):
        at, d = g.ptr[rows[s:s + part]], deg[s:s + part]
        to = out[:len(d)]
        for k, m in enumerate(np.searchsorted(-d, -np.arange(d[0]), "left")):  # the first m rows have a neighbour k
            np.take(values, g.adj[at[:m] + k], axis=0, out=buf[:m] if k else to, mode="clip")
            if k:
                add(to[:m], buf[:m], out=to[:m])
        yield slice(s, s + len(d)), to


class BitSearch:
    """Breadth-first search from up to 64 * ``words`` sources at once: a row of bits per node, one for each source that has reached it."""

    def __init__(self, g: Packed, label: np.ndarray, words: int):
        self.g, self.label, self.deg, self.words = g, label, np.diff(g.ptr), words
        self.bits = np.zeros((len(label), words), np.uint64)

    def _pushed(self, grew: np.ndarray, into: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The marked rows next to those that grew, and their bits with those of the neighbours that grew."""
        e = np.repeat(grew, self.deg)
        to, of = self.g.adj[e], np.repeat(np.flatnonzero(grew), self.deg[grew])
        keep = into[to]
        to, of = to[keep], of[keep]
        order = np.argsort(to, kind="stable")
        to, of = to[order], of[order]
        first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.zeros(0, np.int64)
        rows = to[first]
        return rows, np.bitwise_or.reduceat(self.bits[of], first, axis=0) | self.bits[rows] if len(rows) else self.bits[:0]

    def run(self, sources: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``reached``, ``total`` and ``farthest`` of each node over the sources.

        A row that has all sources of its component is full, and its neighbours are full one level later: they are not read again.
        """
        g, deg, bits, i = self.g, self.deg, self.bits, np.arange(len(sources))
        bits[:] = 0
        bits[sources, i // 64] = np.left_shift(np.uint64(1), (i % 64).astype(np.uint64))
        whole = np.bincount(self.label[sources], minlength=len(deg))[self.label]
        count = np.zeros(len(deg), np.int64)
        count[sources] = 1
        own, total, farthest = count.copy(), np.zeros(len(deg), np.int64), np.zeros(len(deg), np.int32)
        grew, open_ = count > 0, count < whole
        while open_.any():
            total += whole - count
            farthest += open_
            full = _marked(g, deg, grew & ~open_) & open_
            into = open_ & ~full
            if 8 * deg[grew].sum() < len(g.adj):
                rows, new = self._pushed(grew, into)
            else:
                rows = np.flatnonzero(into & _marked(g, deg, grew))
                new = bits[rows]
                for at, more in _gathered(g, deg, bits, rows, np.bitwise_or):
                    new[at] |= more
            was, count = count, count.copy()
            ones, now = np.bitwise_count(new), np.zeros(len(rows), np.int64)
            for k in range(self.words):
                now += ones[:, k]
            count[rows], count[full] = now, whole[full]
            bits[rows] = new
            grew, open_ = count > was, count < whole
        return whole - own, total, farthest


class PathCounts:
    """Brandes' dependencies from up to ``width`` rows at once, a column each."""

    def __init__(self, g: Packed, width: int):
        self.g, self.deg, self.width = g, np.diff(g.ptr), width
        self.at, self.next, self.paths = (np.zeros((len(self.deg), width)) for _ in range(3))
        self.level = np.zeros((len(self.deg), width), np.int32)

    def run(self, sources: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the shortest paths from a node of each source row, times its weight, pass through a node of each row, added up.

        ``at`` holds the numbers of one level only, for all nodes of a row: outward the paths to them, inward the dependency
        a path of theirs brings to the level before. The other nodes of a source's row lie two levels away, behind its
        neighbours, and nothing lies behind them: what they bring to the neighbours is left to the caller.
        """
        g, deg, at, nxt, paths, level = self.g, self.deg, self.at, self.next, self.paths, self.level
        column, many, ones, k = np.arange(len(sources)), g.many[:, None].astype(float), np.ones(self.width), 0
        weight = np.zeros(self.width)
        weight[column] = weights
        at[:], nxt[:], paths[:], level[:], left = 0, 0, 0, -1, np.full(len(deg), len(sources))
        at[sources, column], level[sources, column] = 1, 0
        left[sources] -= 1
        rows, levels = np.sort(sources), []
        while len(rows):
            mark = np.zeros(len(deg), bool)
            mark[rows] = True
            to, k = np.flatnonzero(_marked(g, deg, mark) & (left > 0)), k + 1
            new = np.zeros(len(to))
            for i, got in _gathered(g, deg, at, to, np.add):
                there = to[i]
                was = level[there]
                got *= was < 0
                now = got > 0
                was[now] = k
                level[there] = was
                paths[there] += got
                new[i] = now @ ones
                got *= many[there]
                nxt[there] = got
            left[to] -= new.astype(np.int64)
            at[rows] = 0
            at, nxt, rows = nxt, at, to if new.any() else to[:0]
            levels.append(to)
        total, further = np.zeros(len(deg)), levels[-1]
        for rows in reversed(levels[:-1]):
            k -= 1
            for i, inward in _gathered(g, deg, at, rows, np.add):
                there = rows[i]
                here, count = level[there] == k, paths[there]
                inward *= count
                inward *= here
                total[there] += inward @ weight
                inward += 1
                inward *= many[there]
                inward *= here
                inward /= np.maximum(count, 1)  # a path count is 0 or at least 1
                nxt[there] = inward
            at[further] = 0
            at, nxt, further = nxt, at, rows
        return total


def spread_blocks(edges: DataFrame, blocks: int, work: Callable[[Iterator[int]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``work`` makes of the numbers of the blocks, which are dealt out to two tasks a core; each task has one at least."""
    spark = edges.sparkSession
    tasks = min(blocks, 2 * spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in (p for batch in batches for p in batch.column(0).to_pylist()):
            yield from work(iter(range(p, blocks, tasks)))

    return spark.range(0, tasks, 1, max(1, tasks)).mapInArrow(run, f"node {edges.schema['u'].dataType.simpleString()}, {schema}")


def _by_node(g: Packed, **sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    for s in range(0, len(g.names), 1 << 16):
        yield pa.RecordBatch.from_arrays([g.names[s:s + (1 << 16)], *(pa.array(x[s:s + (1 << 16)]) for x in sums.values())], names=["node", *sums])


def _asked(g: Packed, sources: DataFrame | None) -> np.ndarray:
    """Marks of the nodes that are sources ``(source)``; without sources all are."""
    if sources is None:
        return np.ones(len(g.names), bool)
    some = sources.select("source").where("source is not null").distinct().toArrow()["source"].cast(g.names.type)
    return pc.is_in(g.names, value_set=some.combine_chunks()).to_numpy(zero_copy_only=False)


def distance_sums(edges: DataFrame, g: Packed, sources: DataFrame | None, words: int) -> DataFrame:
    """``(node, reached, total, farthest)`` in one row per node and task that searched."""
    asked = _asked(g, sources)
    number = np.bincount(g.row[asked], minlength=len(g.many))
    words = max(1, min(words, BLOCK_CELLS // max(1, len(g.many)), -(-len(g.many) // 64)))
    blocks = in_blocks(g, number, 64 * words, True)
    sent = edges.sparkSession.sparkContext.broadcast((g, components(g), asked, number, blocks))

    def work(some: Iterator[int]) -> Iterator[pa.RecordBatch]:
        graph, label, asked, number, blocks = sent.value
        search, twins = BitSearch(graph, label, words), 0
        reached, total, farthest = np.zeros((3, len(graph.many)), np.int64)
        for b in some:
            one = search.run(blocks[b])
            times = number[blocks[b][0]]
            reached += times * one[0]
            total += times * one[1]
            farthest = np.maximum(farthest, one[2])
            if b == 0:  # counted once: the other sources of a node's row are two steps away
                twins = number[graph.row] - asked
        at = graph.row
        yield from _by_node(graph, reached=reached[at] + twins, total=total[at] + 2 * twins,
                            farthest=np.maximum(farthest[at], 2 * (twins > 0)).astype(np.int32))

    return spread_blocks(edges, len(blocks), work, "reached long, total long, farthest int")


def dependencies(edges: DataFrame, g: Packed, sources: DataFrame | None) -> DataFrame:
    """``(node, delta)``: what the shortest paths from the sources pass through each node, in one row per node and task that counted."""
    number = np.bincount(g.row[_asked(g, sources)], minlength=len(g.many))
    width = max(1, min(COLUMNS, BLOCK_CELLS // max(1, len(g.many)), len(g.many)))
    blocks = in_blocks(g, number, width, False)
    sent = edges.sparkSession.sparkContext.broadcast((g, number, blocks))

    def work(some: Iterator[int]) -> Iterator[pa.RecordBatch]:
        graph, number, blocks = sent.value
        count, delta = PathCounts(graph, width), np.zeros(len(graph.many))
        for b in some:
            delta += count.run(blocks[b], number[blocks[b]])
            if b == 0:  # counted once: paths between nodes of one row go through its neighbours, an equal share each
                share = number * (graph.many - 1) / graph.ends
                delta += np.bincount(graph.adj, np.repeat(share, np.diff(graph.ptr)), len(delta))
        yield from _by_node(graph, delta=delta[graph.row])

    return spread_blocks(edges, len(blocks), work, "delta double")
