"""Feature building. Parameters are fitted as a one-row aggregate (one job) and applied as
expressions with constants, so a transform is a projection of the scan."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.ordered import bucketize, lookup_join, null_safe_join, one_row, quantiles_wide, row_index
from tallyframe.session import checkpointed


def column_pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations(cols, 2))


def cut(col: str | Column, edges: Sequence[float], labels: Sequence | None = None, include_lowest: bool = False) -> Column:
    """Right-closed bins ``(lo, hi]``; outside is null, and so is the lowest edge unless included."""
    c = F.col(col) if isinstance(col, str) else col
    labels = list(labels) if labels is not None else list(range(len(edges) - 1))
    low = (c >= F.lit(edges[0])) if include_lowest else (c > F.lit(edges[0]))
    out = F.when(c.isNull() | ~low, F.lit(None))
    for hi, label in zip(edges[1:], labels):
        out = out.when(c <= F.lit(hi), F.lit(label))
    return out


def holiday_days(spark: SparkSession, holidays: dict[str, str], before: int = 1, after: int = 1) -> DataFrame:
    """Literal holiday table ``(holiday, day)`` widened to the days around each date."""
    rows = spark.createDataFrame([(n, d) for n, d in holidays.items()], "holiday string, d string")
    return rows.select(
        "holiday", F.explode(F.sequence(F.lit(-before), F.lit(after))).alias("shift"), F.to_date("d").alias("d")
    ).select("holiday", "shift", F.date_add("d", F.col("shift")).alias("day"))


def standard_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population std; a constant column is only centred."""
    src = df if fit_on is None else fit_on
    p = one_row(src.agg(*[e for c in cols for e in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]))
    d = df.withColumn("__p", p)
    sd = lambda c: F.when(F.col(f"__p.s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"__p.s_{c}"))
    return d.withColumns({c: (F.col(c) - F.col(f"__p.m_{c}")) / sd(c) for c in cols}).drop("__p")


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - min) / (max - min); null where the range is zero."""
    src = df if fit_on is None else fit_on
    p = one_row(src.agg(*[e for c in cols for e in (F.min(c).alias(f"a_{c}"), F.max(c).alias(f"b_{c}"))]))
    d = df.withColumn("__p", p)
    return d.withColumns({
        c: F.try_divide(F.col(c) - F.col(f"__p.a_{c}"), F.col(f"__p.b_{c}") - F.col(f"__p.a_{c}")) for c in cols
    }).drop("__p")


def robust_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - median) / IQR with exact quartiles; a zero IQR only centres."""
    src = df if fit_on is None else fit_on
    p = one_row(quantiles_wide(src, cols, {"q1": 0.25, "q2": 0.5, "q3": 0.75}))
    d = df.withColumn("__p", p)
    iqr = lambda c: F.col(f"__p.{c}_q3") - F.col(f"__p.{c}_q1")
    return d.withColumns({
        c: (F.col(c) - F.col(f"__p.{c}_q2")) / F.when(iqr(c) == 0, F.lit(1.0)).otherwise(iqr(c)) for c in cols
    }).drop("__p")


def qcut(df: DataFrame, col: str, q: int, name: str = "bin") -> DataFrame:
    """Quantile bins 0.. with interpolated edges; equal edges merge, the lowest edge is included."""
    probs = {f"e{i}": i / q for i in range(q + 1)}
    wide = quantiles_wide(df, [col], probs)
    edges = wide.select(F.array_sort(F.array_distinct(F.array(*[f"{col}_{k}" for k in probs]))).alias("e")).scalar()
    d = df.withColumn("__e", edges)
    # bin = how many edges lie strictly below the value, shifted so that the lowest edge falls in bin 0
    below = F.size(F.filter("__e", lambda e: e < F.col(col)))
    return d.withColumn(name, F.when(F.col(col).isNotNull(), F.greatest(below - 1, F.lit(0)))).drop("__e")


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


def interaction_terms(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise products (degree 2, no squares) after filling nulls with the column's median."""
    filled = impute_median(df, cols)
    return filled.withColumns({f"{a}__{b}": F.col(a) * F.col(b) for a, b in column_pairs(cols)})


def impute_median(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    p = one_row(quantiles_wide(df if fit_on is None else fit_on, cols, {"med": 0.5}))
    return df.withColumn("__p", p).withColumns({c: F.coalesce(F.col(c), F.col(f"__p.{c}_med")) for c in cols}).drop("__p")


def calendar_features(d: Column) -> dict[str, Column]:
    return {
        "year": F.year(d), "month": F.month(d), "weekday": F.weekday(d), "day_of_year": F.dayofyear(d),
        "iso_week": F.weekofyear(d), "quarter": F.quarter(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "is_first_quarter": (F.month(d) <= 3).cast("int"),
        "is_last_quarter": (F.month(d) >= 10).cast("int"),
    }


def cyclic_features(d: Column) -> dict[str, Column]:
    turn = F.lit(2.0) * F.pi()
    m, w = turn * F.month(d) / 12, turn * F.weekday(d) / 7
    return {"month_sin": F.sin(m), "month_cos": F.cos(m), "weekday_sin": F.sin(w), "weekday_cos": F.cos(w)}


def target_encode(train: DataFrame, apply_to: DataFrame, cat: str, y: str, k: float = 10, name: str = "encoded") -> DataFrame:
    """(n * mean + k * global mean) / (n + k) fitted on train; unseen categories get the global mean."""
    st = train.groupBy(cat).agg(F.count(y).alias("n"), F.sum(y).alias("s"))
    # the global mean is read from the already grouped counts
    g = st.agg(F.try_divide(F.sum("s"), F.sum("n"))).scalar()
    enc = st.withColumn("__g", g).select(cat, ((F.col("s") + k * F.col("__g")) / (F.col("n") + k)).alias("__e"))
    d = lookup_join(apply_to, enc, [cat], "left").withColumn("__g", g)
    return d.withColumn(name, F.coalesce("__e", "__g")).drop("__e", "__g")


def target_encode_loo(df: DataFrame, cat: str, y: str, name: str = "encoded") -> DataFrame:
    """Category mean without the own row; a category of one row gets the global mean.

    Group sums are joined back, not computed in a window, so a hot category is never sorted in one task.
    """
    st = df.groupBy(cat).agg(F.count(y).alias("__n"), F.sum(y).alias("__s"))
    g = st.agg(F.try_divide(F.sum("__s"), F.sum("__n"))).scalar()
    d = lookup_join(df, st, [cat], "left").withColumn("__g", g)
    return d.withColumn(
        name, F.coalesce(F.try_divide(F.col("__s") - F.col(y), F.col("__n") - 1), F.col("__g"))
    ).drop("__n", "__s", "__g")


def one_hot(df: DataFrame, col: str, categories: Sequence[str]) -> DataFrame:
    """One 0/1 column per category; unknown and null give all zeros."""
    return df.withColumns({f"{col}={v}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in categories})


def fitted_categories(train: DataFrame, col: str, limit: int = 1000) -> list[str]:
    """Distinct values in order, for forms with one column each; more than ``limit`` are refused (see ``one_hot_sparse``)."""
    rows = train.where(F.col(col).isNotNull()).select(col).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} categories")
    return sorted(r[0] for r in rows)


def category_index(train: DataFrame, col: str) -> DataFrame:
    """Fitted categories as a table ``(col, index)``: 0 for the most frequent one, ties by the md5 of the value; nulls are none.

    Any number of categories: rows are counted before they are ordered, and the order is cut into buckets, even where most
    categories are equally frequent.
    """
    counts = train.where(F.col(col).isNotNull()).groupBy(col).agg((-F.count(F.lit(1))).alias("__n"))
    counts = counts.withColumn("__h", F.md5(F.col(col).cast("string")))
    cut = bucketize(counts.withColumn("__k", F.conv(F.substring("__h", 1, 15), 16, 10).cast("long")), "__n", "__k")
    ranked = row_index(cut, "__n", "__h", bucket=F.col("__b"))
    return checkpointed(ranked.select(col, (F.col("rn") - 1).cast("int").alias("index")))


def one_hot_sparse(df: DataFrame, col: str, index: DataFrame, name: str = "hot") -> DataFrame:
    """One-hot code as a sparse vector ``(size, indices, values)``, for columns with too many categories for one column each.

    ``index`` is a table made by ``category_index``. Values that it does not hold, and null, give a vector without entries.
    """
    size = one_row(index.agg(F.count(F.lit(1)).cast("int").alias("n")))["n"]
    ix = F.col("__ix.index")
    d = lookup_join(df, index.select(col, F.struct("index").alias("__ix")), [col], "left")
    none = lambda t: F.array().cast(f"array<{t}>")
    return d.withColumn(name, F.struct(
        size.alias("size"), F.when(ix.isNull(), none("int")).otherwise(F.array(ix)).alias("indices"),
        F.when(ix.isNull(), none("double")).otherwise(F.array(F.lit(1.0))).alias("values"))).drop("__ix")


def ordinal(col: str, order: Sequence[str]) -> Column:
    """0-based place in the given order, -1 when unknown."""
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col)) - 1, F.lit(-1)).cast("int")


def column_transformer(train: DataFrame, apply_to: DataFrame, key: str, numeric: Sequence[str], nominal: dict[str, Sequence[str]],
                       ordered: dict[str, Sequence[str]]) -> DataFrame:
    """Numeric: median, then robust scaling; nominal: mode, then one-hot; ordered: mode, then rank. Rest dropped."""
    from tallyframe.operators.relational import mode_value

    med = impute_median(apply_to, numeric, fit_on=train)
    num = robust_scale(med, numeric, fit_on=impute_median(train, numeric))
    cats = [*nominal, *ordered]
    modes = one_row(mode_value(train, cats))
    d = num.withColumn("__m", modes).withColumns({c: F.coalesce(F.col(c), F.col(f"__m.{c}")) for c in cats}).drop("__m")
    for c, values in nominal.items():
        d = one_hot(d, c, values)
    d = d.withColumns({f"{c}_rank": ordinal(c, o) for c, o in ordered.items()})
    hot = [f"{c}={v}" for c, vs in nominal.items() for v in vs]
    return d.select(key, *numeric, *[F.col(f"`{h}`") for h in hot], *[f"{c}_rank" for c in ordered])


def variance_threshold(df: DataFrame, cols: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """Population variance per column and whether it passes."""
    one = df.agg(*[F.var_pop(c).alias(c) for c in cols])
    from tallyframe.operators.relational import unpivot

    return unpivot(one, cols, value="variance").withColumn("keep", F.col("variance") > threshold)


def f_scores(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """ANOVA F of each column against a class, from one grouped aggregate."""
    from tallyframe.operators.stats import anova_from_groups, group_stats

    return anova_from_groups(group_stats(df, cols, label))


def mutual_information(df: DataFrame, x: str, y: str) -> DataFrame:
    """Plug-in estimate in nats from joint and marginal counts."""
    joint = df.groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))
    px = joint.groupBy(x).agg(F.sum("n").alias("nx"))
    py = joint.groupBy(y).agg(F.sum("n").alias("ny"))
    total = joint.agg(F.sum("n")).scalar()
    d = null_safe_join(null_safe_join(joint, px, [x]), py, [y]).withColumn("t", total)
    return d.agg(F.sum(F.col("n") / F.col("t") * F.log(F.col("n").cast("double") * F.col("t") / (F.col("nx").cast("double") * F.col("ny")))).alias("mi"))
