"""Cleaning queries over the dirty views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import cleaning as C, ordered
from tallyframe.plans import views
from tallyframe.plans.registry import query

DL = views.DIRTY_LINEITEM_COLUMNS


@query("missing_profile", f"WITH {views.DIRTY_LINEITEM} SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_missing,
        round((count(*) - count({c})) * 100 / count(*), 2) AS pct FROM dl""" for c in DL) + ") WHERE n_missing > 0")
def missing_profile(t):
    return C.missing_profile(views.dirty_lineitem(t))


def _prof(c, dtype, numeric):
    num = f"""count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS std,
        CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.5), 4) AS q50, CAST(max({c}) AS DOUBLE) AS max""" if numeric \
        else """NULL::BIGINT AS n, NULL::DOUBLE AS mean, NULL::DOUBLE AS std, NULL::DOUBLE AS min, NULL::DOUBLE AS q50,
        NULL::DOUBLE AS max"""
    return f"""SELECT '{c}' AS "column", '{dtype}' AS dtype, 5 AS n_columns, count(*) AS n_rows,
      (SELECT sum(c - 1)::BIGINT FROM (SELECT count(*) AS c FROM dc GROUP BY ALL)) AS n_duplicates, {num} FROM dc"""


@query("table_profile", f"WITH {views.DIRTY_CUSTOMER.replace('dc AS', 'dc0 AS')}, "
       "dc AS (SELECT c_nationkey, c_acctbal, segment, balance_text, c_custkey FROM dc0) " + " UNION ALL ".join([
        _prof("c_custkey", "bigint", True), _prof("c_nationkey", "int", True), _prof("c_acctbal", "double", True),
        _prof("segment", "string", False), _prof("balance_text", "string", False)]).replace(
            "FROM dc GROUP BY ALL", "FROM dc GROUP BY c_custkey, c_nationkey, c_acctbal, segment, balance_text"))
def table_profile(t):
    p = C.table_profile(views.dirty_customer(t))
    return p.select("column", "dtype", "n_columns", "n_rows", "n_duplicates", "n",
                    *[F.round(c, 4).alias(c) for c in ["mean", "std"]], "min", F.round("q50", 4).alias("q50"), "max")


@query("impute_median", f"""
WITH {views.DIRTY_LINEITEM} SELECT l_orderkey, l_linenumber,
  round(coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM dl)), 6) AS l_quantity,
  round(coalesce(l_discount, (SELECT quantile_cont(l_discount, 0.5) FROM dl)), 6) AS l_discount FROM dl""")
def impute_median(t):
    d = C.impute_median(views.dirty_lineitem(t), ["l_quantity", "l_discount"])
    return d.select("l_orderkey", "l_linenumber", F.round("l_quantity", 6).alias("l_quantity"),
                    F.round("l_discount", 6).alias("l_discount"))


@query("impute_mode", f"""
WITH {views.DIRTY_ORDERS} SELECT o_orderkey, coalesce(o_orderpriority, (SELECT o_orderpriority FROM dorders
  WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS o_orderpriority FROM dorders""")
def impute_mode(t):
    return C.impute_mode(views.dirty_orders(t), ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


@query("impute_forward_fill", f"""
WITH {views.DIRTY_EVENTS} SELECT event_id, user_id,
  last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS value FROM de""")
def impute_forward_fill(t):
    return ordered.forward_fill(views.dirty_events(t), "value", "ts", "event_id", ["user_id"]).select(
        "event_id", "user_id", "value")


@query("impute_mean_constant", f"""
WITH {views.DIRTY_LINEITEM} SELECT l_orderkey, l_linenumber,
  round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM dl)), 6) AS l_quantity, coalesce(l_discount, 0.0) AS l_discount FROM dl""")
def impute_mean_constant(t):
    d = C.impute_mean(views.dirty_lineitem(t), ["l_quantity"]).na.fill({"l_discount": 0.0})
    return d.select("l_orderkey", "l_linenumber", F.round("l_quantity", 6).alias("l_quantity"), "l_discount")


IQR = """
qq AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM dl),
bb AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM qq)
"""


@query("iqr_cap", f"""
WITH {views.DIRTY_LINEITEM}, {IQR}
SELECT 'rows' AS part, round(sum(greatest(least(l_extendedprice, hi), lo)), 2) AS capped_sum,
  count(*) FILTER (l_extendedprice < lo OR l_extendedprice > hi) AS n_outliers,
  round(count(*) FILTER (l_extendedprice < lo OR l_extendedprice > hi) / count(*) * 100, 2) AS pct,
  round(min(lo), 2) AS lower, round(min(hi), 2) AS upper FROM dl, bb""")
def iqr_cap(t):
    return C.outlier_stats(views.dirty_lineitem(t), "l_extendedprice").select(
        F.lit("rows").alias("part"), "capped_sum", "n_outliers", "pct", "lower", "upper")


ZS = """
zz AS (SELECT avg(value) AS m, stddev_pop(value) AS p, stddev(value) AS s FROM events)
"""


@query("zscore_cap", f"""
WITH {ZS} SELECT event_id, round(greatest(least(value, m + 3 * s), m - 3 * s), 6) AS value,
  CAST(abs((value - m) / p) > 3 AS INT) AS flagged FROM events, zz""")
def zscore_cap(t):
    d = C.cap_outliers(t.events.select("event_id", "value"), "value", "zscore", flag="flagged")
    return d.select("event_id", F.round("value", 6).alias("value"), "flagged")


@query("outlier_drop", f"""
WITH {ZS} SELECT event_id, value FROM events, zz WHERE NOT abs((value - m) / p) > 3""")
def outlier_drop(t):
    return C.drop_outliers(t.events.select("event_id", "value"), "value")


@query("unit_text_to_number", f"""
WITH {views.DIRTY_CUSTOMER} SELECT c_custkey, TRY_CAST(trim(replace(balance_text, ' Ft', '')) AS DOUBLE) AS balance FROM dc""")
def unit_text_to_number(t):
    return views.dirty_customer(t).select("c_custkey", C.unit_text_to_number(F.col("balance_text")).alias("balance"))


SEGMENTS = ["Automobile", "Building", "Furniture", "Household", "Machinery"]
FIXES = {"Automobil": "Automobile", "Buildin": "Building", "Househol": "Household"}


@query("category_harmonize", f"""
WITH {views.DIRTY_CUSTOMER}, x AS (SELECT c_custkey, segment, upper(substring(trim(segment), 1, 1)) || lower(substring(trim(segment), 2)) AS s FROM dc)
SELECT c_custkey, CASE WHEN segment IS NULL THEN NULL {" ".join(f"WHEN s = '{k}' THEN '{v}'" for k, v in FIXES.items())}
  WHEN s IN ({", ".join(f"'{s}'" for s in SEGMENTS)}) THEN s ELSE 'Other' END AS segment FROM x""")
def category_harmonize(t):
    return views.dirty_customer(t).select("c_custkey", C.harmonize(F.col("segment"), FIXES, SEGMENTS).alias("segment"))


@query("cleaning_steps", f"""
WITH {views.DIRTY_LINEITEM},
mode AS (SELECT l_returnflag AS f FROM dl WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
i AS (SELECT l_orderkey, l_linenumber, coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM dl)) AS l_quantity,
      coalesce(l_extendedprice, (SELECT quantile_cont(l_extendedprice, 0.5) FROM dl)) AS l_extendedprice,
      coalesce(l_discount, (SELECT quantile_cont(l_discount, 0.5) FROM dl)) AS l_discount,
      coalesce(l_returnflag, (SELECT f FROM mode)) AS l_returnflag FROM dl),
b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS p1, quantile_cont(l_extendedprice, 0.75) AS p3,
             quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.75) AS q3 FROM i),
c AS (SELECT DISTINCT l_orderkey, l_linenumber,
        greatest(least(l_quantity, q3 + 1.5 * (q3 - q1)), q1 - 1.5 * (q3 - q1)) AS l_quantity,
        greatest(least(l_extendedprice, p3 + 1.5 * (p3 - p1)), p1 - 1.5 * (p3 - p1)) AS l_extendedprice,
        l_discount, l_returnflag FROM i, b)
SELECT 'before' AS stage, count(*) AS n_rows, CAST(sum((l_quantity IS NULL)::INT + (l_discount IS NULL)::INT) AS BIGINT) AS n_nulls,
       round(sum(l_extendedprice), 1) AS price, sum(l_quantity) AS qty FROM dl
UNION ALL SELECT 'after', count(*), 0, round(sum(l_extendedprice), 1), sum(l_quantity) FROM c""")
def cleaning_steps(t):
    d = views.dirty_lineitem(t)
    c = C.clean(d, ["l_quantity", "l_extendedprice", "l_discount"], ["l_returnflag"], ["l_extendedprice", "l_quantity"])

    def one(x, name):
        nulls = sum((F.col(k).isNull().cast("long") for k in DL), F.lit(0).cast("long"))
        return x.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(nulls).alias("n_nulls"),
                     F.round(F.sum("l_extendedprice"), 1).alias("price"), F.sum("l_quantity").alias("qty")).select(
            F.lit(name).alias("stage"), "n_rows", "n_nulls", "price", "qty")

    return one(d, "before").unionByName(one(c, "after"))
