"""Small relational helpers that are not one built-in call."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.operators.ordered import row_index
from tallyframe.session import checkpointed


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), name: str = "column",
            value: str = "value", cast: str = "double") -> DataFrame:
    """Wide to long in one projection."""
    return df.select(
        *keep,
        F.inline(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast(cast).alias(value)) for c in cols])),
    )


def every_nth(df: DataFrame, n: int, order: str, tie: str) -> DataFrame:
    """Rows 1, n+1, 2n+1, ... of the ordered frame."""
    return row_index(df, order, tie).where((F.col("rn") - 1) % n == 0)


def head(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First n rows of an explicit order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows equal to an earlier row, counted per distinct row before the final sum."""
    g = df.groupBy(*(cols or df.columns)).agg(F.count(F.lit(1)).alias("c"))
    return g.agg(
        F.sum("c").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), F.sum(F.col("c") - 1).alias("n_duplicates")
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in the given order, as a combining aggregate (no window, no hot-key sort)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("s"))
    return packed.select(*keys, "s.*").select(df.columns)


def mode_value(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the smallest on ties; one row, one column per input column.

    Values are counted first, so only distinct values reach the last step.
    """
    counts = unpivot(df, cols, cast="string").where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("c")
    )
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("c"), F.col("value"))).alias("m"))
    return best.agg(*[F.max(F.when(F.col("column") == c, F.col("m"))).alias(c) for c in cols])


def lookup(col: Column, mapping: dict, valid: Sequence | None = None, default=None) -> Column:
    """Literal map lookup; an unmapped value stays if it is valid, else becomes the default."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    keep = F.when(col.isin(list(valid)), col) if valid is not None else F.lit(None)
    return F.when(col.isNotNull(), F.coalesce(F.try_element_at(m, col), keep, F.lit(default)))


def share_of_total(df: DataFrame, key: str) -> DataFrame:
    """Group count and percent of all rows; the total is a scalar of the already grouped counts."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", F.col("n") * 100.0 / g.agg(F.sum("n")).scalar())


def pivot_counts(df: DataFrame, rows: str, cols: str, values: Sequence[str]) -> DataFrame:
    """Contingency table with zero for absent cells; the column values are given, so one pass."""
    return df.groupBy(rows).pivot(cols, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def co_occurrence(df: DataFrame, key: str, item: str) -> DataFrame:
    """Pairs of items a < b that share keys: the number of such keys (``n_keys``) and of row pairs (``n_pairs``).

    Rows are counted per key and item first, and the counts are joined on the key, so row pairs are never formed: a key of any size
    is as many rows as it has different items. Work is the square of that number, so items should be categories. Rows with a null
    key or item take no part.
    """
    one = df.where(F.col(key).isNotNull() & F.col(item).isNotNull()).groupBy(F.col(key).alias("k"), F.col(item).alias("i")).agg(
        F.count(F.lit(1)).alias("n"))
    one = checkpointed(one)
    side = lambda i, n: one.select("k", F.col("i").alias(i), F.col("n").alias(n))
    return side("a", "na").join(side("b", "nb"), "k").where("a < b").groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum(F.col("na") * F.col("nb")).alias("n_pairs"))
