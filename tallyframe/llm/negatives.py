"""Hard-negative mining over shared candidate lists of anchor clusters, with certified termination.

Anchors are clustered by direction. Of every shard of candidates a cluster sorts one list, once, by the angular upper bound:
a candidate at angle t from the centre scores at most ``|x| cos(max(0, t - r))`` times an anchor's length, r being the widest
angle of the cluster. Every member walks that list in blocks and stops where the bound of all that follows lies below the worst
row it would still take. The first walk finds an anchor's positives, the second the negatives of every positive.

Candidates are dealt into shards by hash and anchors into groups of bounded size, a cluster larger than a group being split;
one task holds one shard and one group. All shards meet all groups: the anchors are a stated query set, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.session import checkpointed

#: Components of a shard of candidates, and anchors of a group.
SHARD_CELLS, GROUP_ANCHORS = 1 << 22, 16384
#: Anchors the cluster centres are learned from, the first by hash of the id, and the most centres.
CENTRE_SAMPLE, MAX_CENTRES = 4096, 64
#: Candidates of one step of a walk.
BLOCK = 1024
POSITIVES, NEGATIVES = 5, 10
#: Bounds of a negative's score in hundredths of the positive's.
LOWEST, HIGHEST = 30, 90
SCALE = 256
#: Room for rounding in a bound: relative, and of angles, whose cosine is flat near 0.
SLACK, ANGLE_SLACK = 1e-9, 1e-6


def prepare(table: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(id, label, x)`` of the rows that take part, x being whole numbers.

    Rows with a null id, label or vector, or a null or non-finite component are left out. A vector shorter than another counts
    as continued by zeros. Repeated rows are candidates as often as they are there. Other columns are not looked at.
    """
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = table.where(F.col(id_).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(good, F.lit(False)))
    return rows.select(F.col(id_).cast("long").alias("id"),
                       F.when(F.col(id_) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label)).cast("int").alias("label"),
                       F.transform(x, lambda v: F.floor(SCALE * v).cast("long")).alias("x"))


def _matrix(column, width: int) -> np.ndarray:
    """The lists as rows of one width, continued by zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(lists.offsets))
    flat = np.asarray(lists.flatten(), np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _length(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(_length(x), 1e-300)[:, None]


def centres(anchors: DataFrame, width: int, n: int) -> np.ndarray:
    """Spherical k-means on at most CENTRE_SAMPLE anchors; about one centre for 64 anchors, MAX_CENTRES at most."""
    rows = anchors.orderBy(F.xxhash64("id"), "id").limit(CENTRE_SAMPLE).select("x").toArrow()
    x = _unit(_matrix(rows.column("x"), width).astype(np.float64))
    c = x[: max(1, min(MAX_CENTRES, n // 64))].copy()
    for _ in range(8):
        near = np.argmax(x @ c.T, 1)
        for k in range(len(c)):
            if (near == k).any():
                c[k] = x[near == k].mean(0)
        c = _unit(c)
    return c


def _keep_best(best: tuple, found: tuple, k: int) -> tuple:
    """The first k of each slot by score, then id; both sides are arrays (slot, score, id)."""
    slot, score, ids = (np.concatenate(p) for p in zip(best, found))
    order = np.lexsort((ids, -score, slot))
    slot, score, ids = slot[order], score[order], ids[order]
    start = np.r_[True, slot[1:] != slot[:-1]] if len(slot) else np.zeros(0, bool)
    place = np.arange(len(slot)) - np.maximum.accumulate(np.where(start, np.arange(len(slot)), 0)) if len(slot) else np.zeros(0, int)
    keep = place < k
    return slot[keep], score[keep], ids[keep]


def walk(group: dict, shard: dict, same: bool, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(slot, score, id)`` of the best k rows of the shard for every slot of the group.

    A slot is a window of scores, ``low`` to ``high``, of an anchor ``of``: any score for positives. ``same`` asks for rows of the
    anchor's label other than itself, else for rows of other labels.
    """
    none = (np.zeros(0, np.int64),) * 3
    done = [none]
    x, length, ids, labels = shard["x"], shard["length"], shard["id"], shard["label"]
    unit = x / np.maximum(length, 1e-300)[:, None]
    for c in np.unique(group["cluster"]):
        members = np.flatnonzero(group["cluster"] == c)
        slots = np.flatnonzero(np.isin(group["of"], members))
        if not len(slots):
            continue
        a = group["x"][members]
        centre = _unit(_unit(a).mean(0, keepdims=True))[0]
        widest = np.arccos(np.clip(_unit(a) @ centre, -1, 1)).max() + ANGLE_SLACK
        angle = np.arccos(np.clip(unit @ centre, -1, 1))
        bound = length * np.cos(np.clip(angle - widest, 0, np.pi)) + SLACK * length
        order = np.lexsort((ids, -bound))
        bound = bound[order]
        a_length = _length(a) * (1 + SLACK)
        member_of = np.searchsorted(members, group["of"][slots])
        low, high = group["low"][slots], group["high"][slots]
        need = low.copy()  # the least score a slot would still take
        best, full = none, np.zeros(len(slots), bool)
        worst_id = np.full(len(slots), np.iinfo(np.int64).max)
        open_ = np.ones(len(slots), bool)
        for at in range(0, len(order), BLOCK):
            reach = a_length[member_of] * bound[at] + 1e-6
            open_ &= reach >= need  # bounds only fall, needs only rise: what closes stays closed
            if not open_.any():
                break
            rows = order[at:at + BLOCK]
            live = np.flatnonzero(open_)
            alive, to = np.unique(member_of[live], return_inverse=True)
            score = a[alive] @ x[rows].T
            label_same = group["label"][members[alive]][:, None] == labels[rows][None, :]
            fits = label_same & (group["id"][members[alive]][:, None] != ids[rows][None, :]) if same else ~label_same
            for part in range(0, len(live), 256):
                s, m = live[part:part + 256], to[part:part + 256]
                got = score[m]
                take = fits[m] & (got >= need[s][:, None]) & (got <= high[s][:, None])
                take &= ~full[s][:, None] | (got > need[s][:, None]) | (ids[rows][None, :] < worst_id[s][:, None])
                i, j = np.nonzero(take)
                if not len(i):
                    continue
                hit = np.unique(s[i])
                mine = np.isin(best[0], hit)
                new = _keep_best(tuple(b[mine] for b in best), (s[i], got[i, j].astype(np.int64), ids[rows[j]]), k)
                best = tuple(np.concatenate([b[~mine], n]) for b, n in zip(best, new))
                last = np.flatnonzero(np.r_[new[0][1:] != new[0][:-1], True])
                count = np.diff(np.r_[-1, last])
                ended = last[count == k]
                full[new[0][ended]] = True
                need[new[0][ended]] = np.maximum(need[new[0][ended]], new[1][ended])
                worst_id[new[0][ended]] = new[2][ended]
        done.append((slots[best[0]], best[1], best[2]))
    return tuple(np.concatenate(p) for p in zip(*done))


def _meet(anchors: DataFrame, candidates: DataFrame, shards: int, groups: int, width: int, same: bool, k: int, schema: str,
          slots_of: Callable, out_of: Callable) -> DataFrame:
    """Walks of every group over every shard."""
    left = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = candidates.withColumn("shard", F.pmod(F.xxhash64("id", "x"), F.lit(shards)).cast("int"))
    right = right.withColumn("team", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        ax, bx = _matrix(a.column("x"), width), _matrix(b.column("x"), width)
        peak = float(np.abs(ax).max(initial=0)) * float(np.abs(bx).max(initial=0)) * width
        kind = np.float64 if peak < 2 ** 53 else np.int64
        group = {"x": ax.astype(kind), "id": np.asarray(a.column("id"), np.int64), "label": np.asarray(a.column("label")),
                 "cluster": np.asarray(a.column("cluster")), **slots_of(a)}
        shard = {"x": bx.astype(kind), "id": np.asarray(b.column("id"), np.int64), "label": np.asarray(b.column("label")), "length": _length(bx)}
        return out_of(a, group, *walk(group, shard, same, k))

    return left.groupBy("team", "shard").cogroup(right.groupBy("team", "shard")).applyInArrow(run, schema)


def _best(found: DataFrame, slot: list[str], id_: str, score: str, k: int) -> DataFrame:
    """The best k of every slot over all shards; a shard gives at most k rows of a slot."""
    rank = F.row_number().over(W.partitionBy(*slot).orderBy(F.col(score).desc(), id_))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(table: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = 100) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Rows as in ``prepare``. Anchors are the rows whose id ``every`` divides; of rows that share an anchor's id the one with the
    smallest (label, vector) is the anchor, and none of them is its positive. Ties in score go to the smaller id. An anchor
    without positives and a positive without negatives in its window have no row; an empty table gives none. Scores are 64-bit.
    """
    candidates = checkpointed(prepare(table, id_, vector, label))
    spark = table.sparkSession
    anchors = candidates.where(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "x")).alias("v")).select("id", "v.label", "v.x")
    anchors = checkpointed(anchors)
    n, width = candidates.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    n_anchors = anchors.count()
    if not n_anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    width = max(width, 1)
    shards = max(1, math.ceil(n * width / SHARD_CELLS))
    groups = max(1, math.ceil(n_anchors / GROUP_ANCHORS))
    c = centres(anchors, width, n_anchors)

    def place(batches):
        for b in batches:
            x = _unit(_matrix(b.column(2), width).astype(np.float64))
            near = np.argmax(x @ c.T, 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near)], names=[*b.schema.names, "cluster"])

    placed = checkpointed(anchors.mapInArrow(place, "id long, label int, x array<long>, cluster int"))
    # whole clusters to a group while they fit; one that holds more anchors than a group is cut by a hash
    sizes = {r["cluster"]: r["count"] for r in placed.groupBy("cluster").count().collect()}
    parts = {k: max(1, math.ceil(v / GROUP_ANCHORS)) for k, v in sizes.items()}
    cut = F.element_at(F.create_map(*[F.lit(v) for kv in parts.items() for v in kv]), F.col("cluster"))
    team = F.pmod(F.col("cluster") * 31 + F.pmod(F.xxhash64("id"), cut), F.lit(groups)).cast("int")
    placed = placed.withColumn("team", team)
    far = np.iinfo(np.int64)

    def any_score(a):
        m = a.num_rows
        return {"of": np.arange(m), "low": np.full(m, far.min), "high": np.full(m, far.max)}

    def positives(a, group, slot, score, ids):
        return pa.table({"id": group["id"][slot], "positive_id": ids, "positive_score": score})

    found = _meet(placed, candidates, shards, groups, width, True, POSITIVES, "id long, positive_id long, positive_score long", any_score, positives)
    chosen = checkpointed(_best(found, ["id"], "positive_id", "positive_score", POSITIVES).where("positive_score >= 0"))
    with_slots = placed.join(chosen.groupBy("id").agg(F.collect_list(F.struct("rank", "positive_id", "positive_score")).alias("p")), "id")

    def windows(a):
        p = a.column("p").combine_chunks()
        sizes = np.diff(np.asarray(p.offsets))
        score = np.asarray(p.flatten().field("positive_score"), np.int64)
        whole, part = score // 100, score % 100  # so that no product passes 64 bits
        return {"of": np.repeat(np.arange(a.num_rows), sizes), "low": whole * LOWEST - (-part * LOWEST // 100),
                "high": whole * HIGHEST + part * HIGHEST // 100,
                "place": np.asarray(p.flatten().field("rank")), "positive": np.asarray(p.flatten().field("positive_id"), np.int64), "score": score}

    def negatives(a, group, slot, score, ids):
        return pa.table({"anchor_id": group["id"][group["of"][slot]], "place": group["place"][slot], "positive_id": group["positive"][slot],
                         "positive_score": group["score"][slot], "negative_id": ids, "negative_score": score})

    schema = "anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _meet(with_slots, candidates, shards, groups, width, False, NEGATIVES, schema, windows, negatives)
    best = _best(found, ["anchor_id", "place"], "negative_id", "negative_score", NEGATIVES)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
