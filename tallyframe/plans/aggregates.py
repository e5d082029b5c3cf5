"""Group aggregates and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import aggregates as A, features as FE, relational as R
from tallyframe.operators.ordered import exact_quantiles
from tallyframe.plans.registry import query
from tallyframe.plans.sources import MONTH_REPORT, month_report



@query("group_basic", """
SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS mean, min(c_acctbal) AS lo, max(c_acctbal) AS hi
FROM customer GROUP BY 1 ORDER BY mean DESC""")
def group_basic(t):
    return t.customer.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("c_acctbal"), 6).alias("mean"), F.min("c_acctbal").alias("lo"),
        F.max("c_acctbal").alias("hi")).orderBy(F.desc("mean"))


@query("group_having_limit", """
SELECT p_type, count(*) AS n, sum(l_quantity) AS qty, round(sum(l_extendedprice * (1 - l_discount)), 0) AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type HAVING sum(l_quantity) > 100
ORDER BY revenue DESC, p_type LIMIT 3""")
def group_having_limit(t):
    # sums per part first: the join then moves one row per part, whatever the skew of the lines
    per_part = t.lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"),
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    return (per_part.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("p_type").agg(F.sum("n").alias("n"), F.sum("qty").alias("qty"),
                                   F.round(F.sum("revenue"), 0).alias("revenue"))
            .where("qty > 100").orderBy(F.desc("revenue"), "p_type").limit(3))


@query("group_mean_median", """
SELECT o_orderpriority, round(avg(o_totalprice), 6) AS mean, round(quantile_cont(o_totalprice, 0.5), 4) AS median,
       count(*) AS n FROM orders GROUP BY 1""")
def group_mean_median(t):
    g = A.mean_median_count(t.orders, "o_totalprice", ["o_orderpriority"])
    return g.select("o_orderpriority", F.round("mean", 6).alias("mean"), F.round("median", 4).alias("median"), "n")


@query("named_multi_agg", """
SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 2) AS total,
       round(avg(value), 10) AS mean, max(value) AS hi, count(DISTINCT user_id) AS users
FROM events GROUP BY 1, 2""")
def named_multi_agg(t):
    return t.events.groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"), F.round(F.avg("value"), 10).alias("mean"),
        F.max("value").alias("hi"), F.count_distinct("user_id").alias("users"))


query("monthly_report", MONTH_REPORT)(month_report)


@query("period_category_sum", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1, 2""")
def period_category_sum(t):
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderpriority").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"))


SUMMARY_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("numeric_summary", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS std, min({c}) AS min,
       round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max FROM lineitem""" for c in SUMMARY_COLUMNS))
def numeric_summary(t):
    s = A.numeric_summary(t.lineitem, SUMMARY_COLUMNS)
    return s.select("column", "n", *[F.round(c, 6).alias(c) for c in ["mean", "std", "q25", "q50", "q75"]], "min", "max")


@query("list_summary", """
SELECT o_orderstatus, round(avg(o_totalprice), 4) AS mean, round(stddev_pop(o_totalprice), 4) AS std,
       round(min(o_totalprice), 4) AS min, round(max(o_totalprice), 4) AS max,
       round(quantile_cont(o_totalprice, 0.5), 4) AS median FROM orders GROUP BY 1""")
def list_summary(t):
    return A.list_summary(t.orders, "o_totalprice", ["o_orderstatus"])


@query("value_counts", """
SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3""")
def value_counts(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_type").limit(3)


@query("pivot_counts", """
SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS "F", count(*) FILTER (l_linestatus = 'O') AS "O"
FROM lineitem GROUP BY 1""")
def pivot_counts(t):
    return R.pivot_counts(t.lineitem, "l_returnflag", "l_linestatus", FE.fitted_categories(t.lineitem, "l_linestatus"))


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("crosstab", "SELECT c_mktsegment" + "".join(
    f""", count(*) FILTER (r_name = '{r}') AS "{r}" """ for r in REGIONS) + """
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def crosstab(t):
    d = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    d = d.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return d.groupBy("c_mktsegment").pivot("r_name", FE.fitted_categories(t.region, "r_name")).agg(F.sum("n")).na.fill(0)


@query("share_of_total", """
SELECT o_orderstatus, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct,
       round(avg(CASE WHEN o_totalprice > 250000 THEN 1.0 ELSE 0.0 END), 6) AS share_large FROM orders GROUP BY 1""")
def share_of_total(t):
    flags = t.orders.groupBy("o_orderstatus").agg(
        F.round(F.avg((F.col("o_totalprice") > 250000).cast("double")), 6).alias("share_large"))
    return R.share_of_total(t.orders, "o_orderstatus").withColumn("pct", F.round("pct", 4)).join(flags, "o_orderstatus")


@query("quantiles", " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS p, round(quantile_cont(l_extendedprice, {p}), 6) AS value FROM lineitem"
    for p in (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)))
def quantiles(t):
    q = exact_quantiles(t.lineitem, ["l_extendedprice"], [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0])
    return q.select("p", F.round("value", 6).alias("value"))


@query("mode_value", """
SELECT (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS o_orderpriority,
       (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS o_orderstatus""")
def mode_value(t):
    return R.mode_value(t.orders, ["o_orderpriority", "o_orderstatus"])


@query("moments", """
WITH m AS (SELECT event_type, avg(value) AS mu, stddev_pop(value) AS sd FROM events GROUP BY 1)
SELECT e.event_type, round(min(mu), 4) AS mean, round(min(sd), 4) AS std,
       round(avg(pow(value - mu, 3)) / pow(min(sd), 3), 4) AS skew,
       round(avg(pow(value - mu, 4)) / pow(min(sd), 4) - 3, 4) AS kurt
FROM events e JOIN m ON e.event_type = m.event_type GROUP BY 1""")
def moments(t):
    m = A.moments(t.events, "value", ["event_type"])
    return m.select("event_type", *[F.round(c, 4).alias(c) for c in ["mean", "std", "skew", "kurt"]])


@query("matrix_axis_agg", """
WITH x AS (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos FROM embeddings)
SELECT 'row' AS axis, vec_id AS idx, round(avg(CAST(v AS DOUBLE)), 5) AS value FROM x GROUP BY vec_id
UNION ALL SELECT 'column', CAST(pos AS BIGINT), round(max(CAST(v AS DOUBLE)), 5) FROM x GROUP BY pos""")
def matrix_axis_agg(t):
    r = A.matrix_row_mean(t.embeddings, "vec_id", "embedding").select(
        F.lit("row").alias("axis"), F.col("vec_id").alias("idx"), F.round("mean", 5).alias("value"))
    c = A.matrix_column_max(t.embeddings, "embedding").select(
        F.lit("column").alias("axis"), F.col("pos").cast("long").alias("idx"),
        F.round(F.col("max").cast("double"), 5).alias("value"))
    return r.unionByName(c)
