"""Order-dependent work without a single-task window.

A window without a partition column, or one whose partition column has a hot
value, sends its rows to one task. The operators here cut the order into
buckets of about equal row count (bounds come from one approximate-quantile
aggregate), work inside the buckets and add the carry of the buckets before.
The results are exact: the approximate bounds decide only where the cuts lie.

A value that alone fills several buckets is cut further by the tie-break
column, so neither a hot group nor a hot value ends in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import checkpointed, shuffle_parallelism


def bucket_count(df: DataFrame, buckets: int | None = None) -> int:
    """Next power of two at or above the shuffle parallelism."""
    want = buckets or shuffle_parallelism(df.sparkSession)
    n = 2
    while n < want:
        n *= 2
    return n


def _bounds(df: DataFrame, col: str, n: int) -> Column:
    """The sketch is read once and becomes a constant, so that all uses cut at the same places; times stay a subquery,
    as their way through the driver depends on its time zone."""
    cuts = [i / n for i in range(1, n)]
    sketch = df.agg(F.percentile_approx(col, cuts, max(1000, 20 * n)).alias("b"))
    if not isinstance(df.schema[col].dataType, (T.NumericType, T.StringType)):
        return sketch.scalar()
    return F.lit(sketch.first()["b"]).cast(T.ArrayType(df.schema[col].dataType))


def _search(x: Column, bounds: Column, n: int) -> Column:
    """How many of the n-1 sorted bounds are <= x (binary search, stays in the JVM)."""
    steps, s = [], n // 2
    while s:
        steps.append(s)
        s //= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda i, s: F.when(F.coalesce(F.element_at(bounds, i + s) <= x, F.lit(False)), i + s).otherwise(i),
    )


def bucketize(df: DataFrame, order: str, tie: str | None = None, buckets: int | None = None) -> DataFrame:
    """Adds ``__b`` (long): rows with a smaller ``(order, tie)`` never have a larger ``__b``."""
    n = bucket_count(df, buckets)
    out = df.withColumn("__q", _bounds(df, order, n))
    out = out.withColumn("__b", _search(F.col(order), F.col("__q"), n).cast("long"))
    if tie is not None:
        at = lambda k: F.try_element_at(F.col("__q"), F.greatest(k, F.lit(1)).cast("int"))
        heavy = (F.col("__b") >= 2) & (at(F.col("__b")) == F.col(order)) & (at(F.col("__b") - 1) == F.col(order))
        out = out.withColumn("__t", _bounds(df, tie, n)).withColumn(
            "__b",
            F.col("__b") * (n + 1)
            + F.when(F.coalesce(heavy, F.lit(False)), _search(F.col(tie), F.col("__t"), n)).otherwise(n),
        ).drop("__t")
    return out.drop("__q")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match; keeps the key columns of the left side."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def lookup_join(rows: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join raw rows to a table of group statistics without shuffling the rows when that table is small.

    The planner cannot see how small an aggregate will be and would shuffle both
    sides, the rows by a key that may be hot. So the statistics are written
    first: their true size is then known, and Spark broadcasts them below its
    threshold or falls back to a shuffle join (with skew handling) above it.
    """
    return null_safe_join(rows, checkpointed(stats), keys, how)


def _group_key(by: Sequence[str]) -> list[Column]:
    """One never-null key for a group, so that plain equality joins keep the partitioning of the windows."""
    return [F.struct(*by).alias("__g")] if by else []


def prefix_sums(
    df: DataFrame,
    sums: dict[str, Column],
    order: str,
    tie: str | None = None,
    by: Sequence[str] = (),
    ascending: bool = True,
    inclusive: bool = True,
    buckets: int | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Running sums in ``(order, tie)`` order per ``by`` group, over any number of rows.

    ``(order, tie)`` must be unique inside a group. ``bucket`` replaces the
    quantile buckets when a monotone expression is already at hand. The rows are
    shuffled once, by group and bucket; the window and the join with the carries
    share that partitioning.
    """
    d = df.withColumns({f"__v_{k}": c for k, c in sums.items()})
    d = d.withColumn("__b", bucket) if bucket is not None else bucketize(d, order, tie, buckets)
    d = d.select("*", *_group_key(by))
    g = ["__g"] if by else []
    direction = (lambda c: F.col(c).asc()) if ascending else (lambda c: F.col(c).desc())
    totals = d.groupBy(*g, "__b").agg(*[F.sum(f"__v_{k}").alias(f"__o_{k}") for k in sums])
    before = W.partitionBy(*g).orderBy(direction("__b")).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *g, "__b", *[F.coalesce(F.sum(f"__o_{k}").over(before), F.lit(0)).alias(f"__o_{k}") for k in sums]
    )
    sort = [direction(order)] + ([direction(tie)] if tie else [])
    local = W.partitionBy(*g, "__b").orderBy(*sort).rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    d = d.withColumns({f"__l_{k}": F.coalesce(F.sum(f"__v_{k}").over(local), F.lit(0)) for k in sums})
    d = d.join(offsets, [*g, "__b"])
    return d.withColumns({k: F.col(f"__l_{k}") + F.col(f"__o_{k}") for k in sums}).drop(
        "__b", "__g", *[f"__{p}_{k}" for k in sums for p in "vlo"]
    )


def row_index(df: DataFrame, order: str, tie: str, by: Sequence[str] = (), ascending: bool = True,
              name: str = "rn", **kw) -> DataFrame:
    """Exact 1-based row number per group."""
    return prefix_sums(df, {name: F.lit(1).cast("long")}, order, tie, by, ascending, **kw)


def hash_rank(df: DataFrame, key: str, by: Sequence[str] = (), name: str = "rn", digits: int | None = None) -> DataFrame:
    """1-based rank by ``md5(key)``: a reproducible shuffle. Buckets are hash prefixes, so even;
    the prefix is long enough for at least four buckets per shuffle partition."""
    digits = digits or math.ceil(math.log(4 * bucket_count(df), 16))
    d = df.withColumn("__h", F.md5(F.col(key).cast("string")))
    return row_index(d, "__h", key, by, name=name, bucket=F.substring("__h", 1, digits)).drop("__h")


def forward_fill(df: DataFrame, col: str, order: str, tie: str, by: Sequence[str] = (), name: str | None = None,
                 buckets: int | None = None) -> DataFrame:
    """Last non-null value so far in ``(order, tie)`` order."""
    d = bucketize(df, order, tie, buckets).select("*", *_group_key(by))
    g = ["__g"] if by else []
    # null values lose to any other under max_by with a null key, and a bucket of nulls keeps its row
    key = F.when(F.col(col).isNotNull(), F.struct(order, tie))
    last = d.groupBy(*g, "__b").agg(F.max_by(F.col(col), key).alias("__last"))
    before = W.partitionBy(*g).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    carry = last.select(*g, "__b", F.last("__last", ignorenulls=True).over(before).alias("__carry"))
    local = W.partitionBy(*g, "__b").orderBy(order, tie).rowsBetween(W.unboundedPreceding, 0)
    d = d.withColumn("__f", F.last(col, ignorenulls=True).over(local)).join(carry, [*g, "__b"])
    return d.withColumn(name or col, F.coalesce("__f", "__carry")).drop("__b", "__g", "__f", "__carry")


def bounded_window(
    df: DataFrame,
    exprs: Callable[[object], dict[str, Column]],
    order: str,
    tie: str,
    by: Sequence[str] = (),
    back: int = 1,
    ahead: int = 0,
    block: int = 1 << 16,
) -> DataFrame:
    """Window functions whose frame reaches at most ``back`` / ``ahead`` rows.

    Groups are cut into blocks of ``block`` rows; rows near a cut are copied to
    the neighbour block so each frame is complete, and the copies are dropped.
    ``exprs`` gets the ordered window spec and returns the new columns.
    """
    block = max(block, back, ahead, 1)
    d = row_index(df, order, tie, by, name="__i")
    blk = F.floor((F.col("__i") - 1) / block).cast("long")
    pos = (F.col("__i") - 1) % block
    d = d.withColumn("__home", blk).withColumn(
        "__blk",
        F.explode(
            F.filter(
                F.array(
                    blk,
                    F.when(pos >= block - back, blk + 1),
                    F.when((pos < ahead) & (blk > 0), blk - 1),
                ),
                lambda b: b.isNotNull(),
            )
        ),
    )
    w = W.partitionBy(*by, "__blk").orderBy("__i")
    d = d.withColumns(exprs(w))
    return d.where(F.col("__home") == F.col("__blk")).drop("__home", "__blk", "__i")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    accuracy: int = 10000) -> DataFrame:
    """Exact linearly interpolated quantiles: rows ``(*by, column, p, value, n)``.

    Spark's exact ``percentile`` keeps every distinct value of a group in one
    buffer. Here a sketch first brackets each wanted rank; then one counting
    pass keeps single values only inside the brackets (about 4/accuracy of the
    rows each) and reduces what lies between two brackets to its count,
    smallest and largest value before the shuffle.
    A bracket that misses its rank raises instead of returning a wrong value.
    """
    pad = 2.0 / accuracy
    probs = sorted(set(map(float, probs)))
    sketch_probs = [q for p in probs for q in (max(0.0, p - pad), min(1.0, p + pad))]
    keys = [*by, "column"]
    base = df.select(*by, *[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(cols)])
    wide = base.groupBy(*by).agg(*[e for i in range(len(cols)) for e in (
        F.count(f"__v{i}").alias(f"__n{i}"), F.percentile_approx(f"__v{i}", sketch_probs, accuracy).alias(f"__q{i}"))])
    if by:
        d = lookup_join(base, wide, by)
    else:
        d = base.withColumn("__p", one_row(wide))
        d = d.withColumns({f"__{k}{i}": F.col(f"__p.__{k}{i}") for i in range(len(cols)) for k in "nq"})
    d = d.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"__v{i}").alias("v"), F.col(f"__n{i}").alias("n"), F.col(f"__q{i}").alias("q"))
        for i, c in enumerate(cols)]))).where(F.col("v").isNotNull())
    v = F.col("v")
    lo, hi = [F.col("q")[2 * i] for i in range(len(probs))], [F.col("q")[2 * i + 1] for i in range(len(probs))]
    inside = reduce(lambda x, y: x | y, [(v >= a) & (v <= b) for a, b in zip(lo, hi)])
    gap = sum(((v > b).cast("int") for b in hi), F.lit(0))
    runs = (
        d.select(*keys, "n", "v", F.when(inside, v).alias("single"), F.when(~inside, gap).alias("gap"))
        .groupBy(*keys, "n", "gap", "single")
        .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("mn"), F.max("v").alias("mx"))
    )
    # the runs are disjoint value ranges, so their order is the order of their smallest values; a column's or group's
    # runs grow with the rows, so their running count is cut into buckets like any other
    runs = prefix_sums(checkpointed(runs), {"cum": F.col("c")}, "mn", None, by=keys)

    def at(rank):
        """First run that reaches the rank; outside the brackets only its two ends are known."""
        r = F.min(F.when(F.col("cum") >= rank, F.struct("cum", "c", "mn", "mx")))
        known = F.when(r["mn"] == r["mx"], r["mn"]).when(rank == r["cum"], r["mx"]).when(rank == r["cum"] - r["c"] + 1, r["mn"])
        return known.otherwise(F.raise_error(F.lit("quantile bracket missed; raise accuracy")).cast("double"))

    picked = runs.groupBy(*keys, "n").agg(*[e for i, p in enumerate(probs) for e in (
        at(F.floor((F.col("n") - 1) * p) + 1).alias(f"a{i}"), at(F.ceil((F.col("n") - 1) * p) + 1).alias(f"b{i}"))])
    part = lambda p: (F.col("n") - 1) * p - F.floor((F.col("n") - 1) * p)
    return picked.select(*keys, "n", F.inline(F.array(*[
        F.struct(F.lit(p).alias("p"), (F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * part(p)).alias("value"))
        for i, p in enumerate(probs)]))).select(*keys, "p", "value", "n")


def quantiles_wide(df: DataFrame, cols: Sequence[str], probs: dict[str, float], by: Sequence[str] = (),
                   accuracy: int = 10000) -> DataFrame:
    """One row per group with columns ``<column>_<name>`` for each named probability."""
    q = exact_quantiles(df, cols, list(dict.fromkeys(probs.values())), by, accuracy)
    return q.groupBy(*by).agg(*[
        F.max(F.when((F.col("column") == c) & (F.col("p") == float(p)), F.col("value"))).alias(f"{c}_{name}")
        for c in cols for name, p in probs.items()
    ])


def one_row(params: DataFrame) -> Column:
    """Fitted parameters: a one-row aggregate is read to the driver and becomes a constant struct.

    The fit is one job over the input; applying it needs no join, and a chain of
    fits does not run the earlier ones again.
    """
    row = params.first()
    value = lambda f: F.lit(row[f.name] if row is not None else None).cast(f.dataType)
    return F.struct(*[value(f).alias(f.name) for f in params.schema.fields])


def value_ranks(df: DataFrame, col: str, by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Distinct values with ``cnt`` and the tie-averaged rank ``avg_rank``; ties collapse before ordering."""
    vc = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count(F.lit(1)).alias("cnt"))
    return prefix_sums(vc, {"__c": F.col("cnt")}, col, None, by, inclusive=False, buckets=buckets).withColumn(
        "avg_rank", F.col("__c") + (F.col("cnt") + 1) / 2
    ).drop("__c")
