"""Clustering and cluster quality."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators.graph import connected_components
from tallyframe.operators.ordered import lookup_join, one_row
from tallyframe.session import checkpointed

SEED = 42


def silhouette(df: DataFrame, vec: str, label: str, noise: int | None = -1) -> DataFrame:
    """Mean silhouette with squared Euclidean distance, exact and without pairs.

    The mean squared distance of x to a cluster is |x|² - 2 x·mean + mean|y|²,
    so each row needs one summary per cluster: its size, mean vector and mean
    squared length. Those summaries travel as one array (clusters × dimensions).
    """
    d = df.select(F.transform(vec, lambda v: v.cast("double")).alias("x"), F.col(label).alias("c"))
    if noise is not None:
        d = d.where(F.col("c") != noise)
    sq = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    pos = d.select("c", F.posexplode("x").alias("p", "v")).groupBy("c", "p").agg(F.avg("v").alias("m"))
    mean = pos.groupBy("c").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "m"))), lambda s: s["m"]).alias("m"))
    size = d.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.avg(sq).alias("q"))
    ks = mean.join(size, "c").agg(F.collect_list(F.struct("c", "n", "m", "q"))).scalar()
    dot = lambda m: F.aggregate(F.zip_with("x", m, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    d = d.withColumn("ks", ks).withColumn("xx", sq)
    d = d.withColumn("ds", F.transform("ks", lambda k: F.struct(
        k["c"].alias("c"), k["n"].alias("n"), F.greatest(F.col("xx") - 2 * dot(k["m"]) + k["q"], F.lit(0.0)).alias("d"))))
    own = F.filter("ds", lambda k: k["c"] == F.col("c"))[0]
    d = d.withColumn("n", own["n"]).withColumn("a", F.try_divide(own["d"] * own["n"], own["n"] - 1))
    d = d.withColumn("b", F.array_min(F.transform(F.filter("ds", lambda k: k["c"] != F.col("c")), lambda k: k["d"])))
    s = F.when(F.col("n") == 1, 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return d.agg(F.count(F.lit(1)).alias("n"), F.avg(s).alias("silhouette"))


def vectorised(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(df)


def kmeans_curve(df: DataFrame, cols: Sequence[str], ks: Sequence[int]) -> DataFrame:
    """Inertia and silhouette per k; each fit scans the persisted features."""
    d = vectorised(df, cols).persist()
    rows = []
    for k in ks:
        model = KMeans(k=k, seed=SEED, maxIter=20).fit(d)
        s = silhouette(model.transform(d).select(F.array(*cols).alias("x"), "prediction"), "x", "prediction", None).first()
        rows.append((int(k), float(model.summary.trainingCost), float(s["silhouette"])))
    d.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def kmeans(df: DataFrame, cols: Sequence[str], k: int = 4) -> DataFrame:
    d = vectorised(df, cols)
    return KMeans(k=k, seed=SEED, maxIter=20).fit(d).transform(d).drop("features").withColumnRenamed("prediction", "cluster")


def micro_clusters(df: DataFrame, cols: Sequence[str], most: int = 2000) -> tuple[DataFrame, DataFrame]:
    """The rows with their ``cell``, and the clustering features ``(cell, n, <col>...)`` (means) of at most ``most`` cells.

    Where there are no more distinct points than that, every point is its own cell. Otherwise the cells are those of the finest
    grid of halved ranges that fits; the sizes of all grids come from one pass. Rows with a null coordinate have a null cell.
    """
    lo_hi = one_row(df.agg(*[e for c in cols for e in (F.min(c).cast("double").alias(f"lo_{c}"), F.max(c).cast("double").alias(f"hi_{c}"))]))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    at = lambda k: F.array(*[F.least(F.floor(F.coalesce(F.try_divide(F.col(c) - lo_hi[f"lo_{c}"], lo_hi[f"hi_{c}"] - lo_hi[f"lo_{c}"]), F.lit(0.0)) * 2 ** k),
                                     F.lit(2 ** k - 1)).cast("double") for c in cols])
    grids = [F.array(*[F.col(c).cast("double") for c in cols]), *[at(k) for k in range(16, -1, -1)]]
    sizes = df.where(whole).agg(*[F.approx_count_distinct(F.xxhash64(g), 0.02).alias(str(i)) for i, g in enumerate(grids)]).first()
    for i, g in enumerate(grids):
        if sizes[i] > 1.1 * most and i + 1 < len(grids):
            continue
        rows = df.withColumn("cell", F.when(whole, g))
        cells = checkpointed(rows.where(whole).groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols]))
        if i + 1 == len(grids) or cells.count() <= most:
            return rows, cells
    raise AssertionError("the coarsest grid has one cell")


def ward_merges(points: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, float, int]]:
    """Ward's tree of weighted points by the nearest-neighbour chain: ``(left, right, height, rows)`` from the lowest up.

    Points are 0 to m - 1, the merge at place k makes cluster m + k. Heights are those of the usual Ward linkage:
    ``sqrt(2 a b / (a + b))`` times the distance of the means.
    """
    m = len(points)
    mean, size, alive = np.vstack([points, np.zeros_like(points)]).astype(float), np.r_[sizes, np.zeros(m)].astype(float), np.zeros(2 * m, bool)
    alive[:m] = True
    found, chain, new = [], [], m
    while len(found) < m - 1:
        if not chain:
            chain.append(int(np.argmax(alive)))
        i = chain[-1]
        others = np.flatnonzero(alive)
        others = others[others != i]
        d = 2 * size[others] * size[i] / (size[others] + size[i]) * ((mean[others] - mean[i]) ** 2).sum(1)
        k = int(np.argmin(d))
        j = int(others[k])
        if len(chain) > 1 and d[others == chain[-2]][0] <= d[k]:
            j, k = chain[-2], int(np.flatnonzero(others == chain[-2])[0])
            del chain[-2:]
            size[new] = size[i] + size[j]
            mean[new] = (mean[i] * size[i] + mean[j] * size[j]) / size[new]
            alive[[i, j]], alive[new] = False, True
            found.append((i, j, float(np.sqrt(d[k])), new))
            new += 1
        else:
            chain.append(j)
    order = sorted(range(len(found)), key=lambda x: (found[x][2], x))
    name = {found[x][3]: m + place for place, x in enumerate(order)}
    return [(*sorted((name.get(found[x][0], found[x][0]), name.get(found[x][1], found[x][1]))), found[x][2], int(size[found[x][3]])) for x in order]


def _tree(df: DataFrame, cols: Sequence[str], most: int):
    rows, cells = micro_clusters(df, cols, most)
    kept = cells.orderBy("cell").collect()  # at most ``most`` rows
    return rows, kept, ward_merges(np.array([[float(r[c]) for c in cols] for r in kept]).reshape(len(kept), len(cols)), np.array([r["n"] for r in kept]))


def ward_tree(df: DataFrame, cols: Sequence[str], most: int = 2000) -> DataFrame:
    """The merges as a table ``(step, left, right, height, n)``; numbers below the count of features are features."""
    _, _, merges = _tree(df, cols, most)
    return df.sparkSession.createDataFrame([(k, *m) for k, m in enumerate(merges)], "step int, left int, right int, height double, n long")


def hierarchical(df: DataFrame, cols: Sequence[str], height: float | None = None, leaves: int = 8, most: int = 2000) -> DataFrame:
    """Ward clusters of the rows (``cluster``), cut at a height or, without one, where ``leaves`` are left.

    Rows are first summed into at most ``most`` clustering features, whose tree is built on the driver; on no more distinct
    points than that it is Ward's tree of the points. Clusters are numbered by their first feature in order of coordinates. Rows with a
    null coordinate have no cluster.
    """
    rows, kept, merges = _tree(df, cols, most)
    m = len(kept)
    up = list(range(2 * m))
    for k, (a, b, h, _) in enumerate(merges):
        if (h > height) if height is not None else (m - k <= leaves):
            break
        up[a] = up[b] = m + k

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    number: dict[int, int] = {}
    labels = [(list(r["cell"]), number.setdefault(root(i), len(number))) for i, r in enumerate(kept)]
    named = df.sparkSession.createDataFrame(labels, "cell array<double>, cluster int")
    return rows.join(F.broadcast(named), "cell", "left").drop("cell")  # at most ``most`` rows


def _gap2(lo1, hi1, lo2, hi2):
    """Squared distance of two intervals, 0 where they overlap."""
    g = F.greatest(F.col(lo1) - F.col(hi2), F.col(lo2) - F.col(hi1), F.lit(0.0))
    return g * g


def _reach2(lo1, hi1, lo2, hi2):
    """Squared largest distance of two intervals."""
    g = F.greatest(F.col(hi1) - F.col(lo2), F.col(hi2) - F.col(lo1))
    return g * g


def _neighbour_cells(d: DataFrame) -> DataFrame:
    off = F.array(*[F.struct(F.lit(i).cast("long").alias("dx"), F.lit(j).cast("long").alias("dy")) for i in range(-2, 3) for j in range(-2, 3)])
    return d.select("*", F.inline(off)).withColumns({"nx": F.col("cx") + F.col("dx"), "ny": F.col("cy") + F.col("dy")}).drop("dx", "dy")


def cell_links(core: DataFrame, eps: float, side: float, rounds: int = 60) -> DataFrame:
    """Pairs of neighbouring grid cells that hold core points within eps of each other.

    Cells are compared by the tight boxes around their points, halved from
    round to round: a pair is linked once two boxes lie within eps as a whole,
    dropped once all boxes are further apart. Point pairs are never formed; boxes
    of one point are decided at once, because their nearest and farthest distances agree.
    """
    def boxes(level):
        s = side / (1 << level)
        return core.groupBy("cx", "cy", F.floor(F.col("x") / s).alias("bx"), F.floor(F.col("y") / s).alias("by")).agg(
            F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))

    cells = core.select("cx", "cy").distinct()
    near = _neighbour_cells(cells).where("nx > cx OR (nx = cx AND ny > cy)")
    open_pairs = checkpointed(near.join(cells.select(F.col("cx").alias("nx"), F.col("cy").alias("ny")), ["nx", "ny"]))
    linked = []
    cand = None  # box pairs still open, named by the parents' indexes
    for level in range(rounds):
        if open_pairs.isEmpty():
            break
        b = boxes(level)
        ren = lambda p: b.select(*[F.col(c).alias(f"{p}_{c}") for c in b.columns])
        if cand is None:
            j = open_pairs.join(ren("l"), (F.col("l_cx") == F.col("cx")) & (F.col("l_cy") == F.col("cy"))).join(
                ren("r"), (F.col("r_cx") == F.col("nx")) & (F.col("r_cy") == F.col("ny")))
        else:
            half = lambda p: [F.floor(F.col(f"{p}_b{a}") / 2) for a in "xy"]
            lx, ly = half("l")
            rx, ry = half("r")
            j = cand.join(ren("l"), (F.col("l_cx") == F.col("cx")) & (F.col("l_cy") == F.col("cy")) & (lx == F.col("plx")) & (ly == F.col("ply")))
            j = j.join(ren("r"), (F.col("r_cx") == F.col("nx")) & (F.col("r_cy") == F.col("ny")) & (rx == F.col("prx")) & (ry == F.col("pry")))
        low = _gap2("l_x0", "l_x1", "r_x0", "r_x1") + _gap2("l_y0", "l_y1", "r_y0", "r_y1")
        high = _reach2("l_x0", "l_x1", "r_x0", "r_x1") + _reach2("l_y0", "l_y1", "r_y0", "r_y1")
        j = checkpointed(j.select("cx", "cy", "nx", "ny", F.col("l_bx").alias("plx"), F.col("l_by").alias("ply"), F.col("r_bx").alias("prx"),
                                  F.col("r_by").alias("pry"), low.alias("low"), high.alias("high")).where(F.col("low") <= eps * eps))
        yes = checkpointed(j.where(F.col("high") <= eps * eps).select("cx", "cy", "nx", "ny").distinct())
        linked.append(yes)
        cand = j.join(yes, ["cx", "cy", "nx", "ny"], "left_anti").drop("low", "high")
        cand = checkpointed(cand)
        open_pairs = cand.select("cx", "cy", "nx", "ny").distinct()
    if linked and not open_pairs.isEmpty():
        raise RuntimeError(f"cell pairs still undecided after {rounds} halvings")
    out = linked[0] if linked else open_pairs.select("cx", "cy", "nx", "ny")
    for x in linked[1:]:
        out = out.unionByName(x)
    return out


def within_reach(points: DataFrame, targets: DataFrame, by: Sequence[str], eps: float, side: float, enough: int, rounds: int = 20) -> DataFrame:
    """How many targets lie within eps of each point: ``(*by, k)``, exact below ``enough`` and at least ``enough`` from there on.

    ``points`` hold ``by``, ``x``, ``y`` and the cell to look at (``nx``, ``ny``); ``targets`` hold ``cx``, ``cy``, ``x``, ``y``.
    A cell is met as the tight boxes around its targets. A box within eps as a whole counts with its number, one further away
    falls, and the others are cut in eight each way for the next round; points that have enough stop. So a point never meets all
    targets of a crowded cell, and equal targets are one box.
    """
    def boxes(level):
        s = side / (1 << 3 * level)
        return targets.groupBy("cx", "cy", F.floor(F.col("x") / s).alias("bx"), F.floor(F.col("y") / s).alias("by")).agg(
            F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count(F.lit(1)).alias("n"))

    keep = [*by, "x", "y", "nx", "ny"]
    open_, found, counts = points.select(*dict.fromkeys(keep)), [], None
    for level in range(rounds):
        b = boxes(level).withColumnsRenamed({"cx": "nx", "cy": "ny"})
        if level:
            b = b.withColumns({"px": F.floor(F.col("bx") / 8), "py": F.floor(F.col("by") / 8)})
        j = open_.join(b, ["nx", "ny"] + (["px", "py"] if level else []))
        gap = lambda c: F.greatest(F.col(f"{c}0") - F.col(c), F.col(c) - F.col(f"{c}1"), F.lit(0.0))
        far = lambda c: F.greatest(F.col(f"{c}1") - F.col(c), F.col(c) - F.col(f"{c}0"))
        j = j.where(gap("x") * gap("x") + gap("y") * gap("y") <= eps * eps)
        j = checkpointed(j.select(*dict.fromkeys(keep), F.col("bx").alias("px"), F.col("by").alias("py"), "n",
                                  (far("x") * far("x") + far("y") * far("y") <= eps * eps).alias("whole")))
        found.append(j.where("whole").groupBy(*by).agg(F.sum("n").alias("k")))
        counts = checkpointed(reduce(DataFrame.unionByName, found).groupBy(*by).agg(F.sum("k").alias("k")))
        found = [counts]
        open_ = checkpointed(j.where("NOT whole").drop("n", "whole").join(counts.where(F.col("k") >= enough), list(by), "left_anti"))
        if open_.isEmpty():
            return counts
    raise RuntimeError(f"points still undecided after {rounds} rounds")


def dbscan(df: DataFrame, key: str, x: str, y: str, eps: float = 0.4, min_samples: int = 5) -> DataFrame:
    """Exact DBSCAN in two dimensions: (key, cluster, is_core); cluster = smallest core key, noise = -1.

    Grid cells of side eps/√2: points of one cell are always within eps, so a
    cell with ``min_samples`` points is all core and needs no pairs. Only points
    of emptier cells look at neighbour cells, at most (min_samples - 1) per cell,
    and meet them as boxes until they have enough neighbours (``within_reach``).
    A border point joins its smallest neighbouring cluster. Points with a null or not finite coordinate are noise.
    """
    side = eps / math.sqrt(2)
    p = df.select(F.col(key).alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    finite = lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))
    lost = p.where(~(finite(F.col("x")) & finite(F.col("y")))).select("id", F.lit(-1).cast("long").alias("cluster"), F.lit(False).alias("is_core"))
    p = p.where(finite(F.col("x")) & finite(F.col("y")))
    p = p.withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
    size = p.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    p = checkpointed(lookup_join(p, size, ["cx", "cy"]))
    counts = within_reach(_neighbour_cells(p.where(F.col("n") < min_samples)), p, ["id"], eps, side, min_samples)
    p = checkpointed(p.join(counts, "id", "left").withColumn(
        "is_core", (F.col("n") >= min_samples) | (F.coalesce("k", F.lit(0)) >= min_samples)).drop("k"))
    core = p.where("is_core")
    links = cell_links(core.select("cx", "cy", "x", "y"), eps, side)
    # a cell is named by its smallest core key
    name = checkpointed(core.groupBy("cx", "cy").agg(F.min("id").alias("cell")))
    left = links.join(name.withColumnRenamed("cell", "u"), ["cx", "cy"])
    edges = left.join(name.select(F.col("cx").alias("nx"), F.col("cy").alias("ny"), F.col("cell").alias("v")), ["nx", "ny"]).select("u", "v")
    comp = connected_components(edges, name.select(F.col("cell").alias("node")))
    cells = name.join(comp, F.col("cell") == F.col("node")).select("cx", "cy", F.col("component").alias("cluster"))
    cells = checkpointed(cells)
    border = within_reach(_neighbour_cells(p.where("NOT is_core")), core, ["id", "nx", "ny"], eps, side, 1).join(
        cells.select(F.col("cx").alias("nx"), F.col("cy").alias("ny"), "cluster"), ["nx", "ny"])
    border = border.groupBy("id").agg(F.min("cluster").alias("cluster"))
    done = lookup_join(core, cells, ["cx", "cy"]).select("id", "cluster", F.lit(True).alias("is_core"))
    rest = p.where("NOT is_core").join(border, "id", "left").select(
        "id", F.coalesce("cluster", F.lit(-1).cast("long")).alias("cluster"), F.lit(False).alias("is_core"))
    return done.unionByName(rest).unionByName(lost).withColumnRenamed("id", key)


def cluster_count(labels: DataFrame) -> DataFrame:
    return labels.agg(F.count_distinct(F.when(F.col("cluster") != -1, F.col("cluster"))).alias("clusters"), F.count_if(F.col("cluster") == -1).alias("noise"))
