"""Joins and window functions."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.operators import features as FE, relational as RL, windows as WD
from tallyframe.operators.ordered import lookup_join, value_ranks
from tallyframe.plans import views
from tallyframe.plans.registry import query



@query("inner_join_agg", """
SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 1) AS mean
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def inner_join_agg(t):
    per = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    d = per.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    d = d.groupBy("c_mktsegment").agg(F.sum("n").alias("n"), F.sum("total").alias("s"))
    return d.select("c_mktsegment", "n", F.round("s", 2).alias("total"), F.round(F.col("s") / F.col("n"), 1).alias("mean"))


@query("left_join_count", """
SELECT c_custkey, c_name, count(o_orderkey) AS n_orders FROM customer LEFT JOIN orders
  ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT' AND o_totalprice > 450000 GROUP BY 1, 2""")
def left_join_count(t):
    per = t.orders.where("o_orderpriority = '1-URGENT' AND o_totalprice > 450000").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("k"))
    return t.customer.join(per, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "c_name", F.coalesce("k", F.lit(0).cast("long")).alias("n_orders"))


@query("star_join", """
SELECT l_orderkey, l_linenumber, p_name, p_type, s_name, round(l_extendedprice * (1 - l_discount), 0) AS net
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""")
def star_join(t):
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return d.select("l_orderkey", "l_linenumber", "p_name", "p_type", "s_name",
                    F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 0).alias("net"))


@query("lookup_join_default", """
WITH st AS (SELECT c_nationkey AS k, avg(c_acctbal) AS m FROM customer WHERE c_acctbal > 9950 GROUP BY 1)
SELECT c_custkey, round(coalesce(m, (SELECT avg(c_acctbal) FROM customer WHERE c_acctbal > 9950)), 4) AS enc
FROM customer LEFT JOIN st ON c_nationkey = k""")
def lookup_join_default(t):
    rich = t.customer.where("c_acctbal > 9950")
    st = rich.groupBy(F.col("c_nationkey").alias("k")).agg(F.avg("c_acctbal").alias("m"))
    mean = rich.agg(F.avg("c_acctbal")).scalar()
    d = lookup_join(t.customer, st.withColumnRenamed("k", "c_nationkey"), ["c_nationkey"], "left")
    return d.select("c_custkey", F.round(F.coalesce("m", mean), 4).alias("enc"))


FIXED_DATES = ["1996-01-01", "1996-12-25", "1997-05-01", "1998-03-15", "1999-10-23", "2000-08-20"]
BANDS = [0, 10, 25, 40, 50]
BAND_NAMES = ["small", "medium", "large", "bulk"]


@query("interval_join", f"""
SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'small' WHEN l_quantity <= 25 THEN 'medium'
            WHEN l_quantity <= 40 THEN 'large' WHEN l_quantity <= 50 THEN 'bulk' END AS bucket,
       count(*) AS n, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY 1
UNION ALL
SELECT strftime(h, '%Y-%m-%d'), count(*), round(sum(o_totalprice), 2) FROM orders
JOIN (SELECT unnest([{", ".join(f"DATE '{d}'" for d in FIXED_DATES)}]) AS h)
  ON CAST(o_orderdate AS DATE) BETWEEN h - INTERVAL 1 DAY AND h + INTERVAL 1 DAY GROUP BY 1""")
def interval_join(t):
    bands = t.lineitem.groupBy(FE.cut("l_quantity", BANDS, BAND_NAMES).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("total"))
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"))
    near = FE.holiday_days(t.spark, {d: d for d in FIXED_DATES})
    h = days.join(near, "day").groupBy(F.col("holiday").alias("bucket")).agg(
        F.sum("n").alias("n"), F.round(F.sum("s"), 2).alias("total"))
    return bands.unionByName(h)


PAIR_COLUMNS = ["l_discount", "l_extendedprice", "l_quantity", "l_tax"]
PAIRS = [(a, b) for i, a in enumerate(PAIR_COLUMNS) for b in PAIR_COLUMNS[i + 1:]]


@query("self_pair_join", """
WITH x AS (SELECT l_orderkey, n_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2)
SELECT x.n_name AS a, y.n_name AS b, count(*) AS n_orders, sum(x.n * y.n)::BIGINT AS n_pairs
FROM x JOIN x AS y ON x.l_orderkey = y.l_orderkey AND x.n_name < y.n_name GROUP BY 1, 2""")
def self_pair_join(t):
    """Nations that supply the same order, joined on the order with a < b."""
    home = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")
    d = t.lineitem.select("l_orderkey", "l_suppkey").join(home, F.col("l_suppkey") == F.col("s_suppkey"))
    return RL.co_occurrence(d, "l_orderkey", "n_name").withColumnRenamed("n_keys", "n_orders")


@query("column_pairs", " UNION ALL ".join(
    f"SELECT '{a}' AS c1, '{b}' AS c2, count(*) FILTER ({a} < {b}) AS n_less, round(avg({a} * {b}), 4) AS mean_product "
    "FROM lineitem" for a, b in PAIRS))
def column_pairs(t):
    """Every unordered pair of columns, all measured in one pass over the rows."""
    pairs = FE.column_pairs(PAIR_COLUMNS)
    one = t.lineitem.agg(*[e for i, (a, b) in enumerate(pairs) for e in (
        F.count_if(F.col(a) < F.col(b)).alias(f"l{i}"), F.avg(F.col(a) * F.col(b)).alias(f"p{i}"))])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("c1"), F.lit(b).alias("c2"), F.col(f"l{i}").alias("n_less"),
                 F.round(f"p{i}", 4).alias("mean_product")) for i, (a, b) in enumerate(pairs)])))


@query("rank_over_agg", """
SELECT o_custkey, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS rnk FROM orders GROUP BY 1""")
def rank_over_agg(t):
    return WD.competition_rank(t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), "n", "rnk").select("o_custkey", "n", "rnk")


@query("running_sum", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS total,
       round(sum(sum(o_totalprice)) OVER (ORDER BY strftime(o_orderdate, '%Y-%m')), 2) AS running
FROM orders GROUP BY 1 ORDER BY 1 LIMIT 12""")
def running_sum(t):
    m = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.sum("o_totalprice").alias("s"))
    return m.select("month", F.round("s", 2).alias("total"),
                    F.round(F.sum("s").over(W.orderBy("month")), 2).alias("running")).orderBy("month").limit(12)


@query("row_number_dense_lead", """
SELECT event_id, user_id, row_number() OVER w AS rn, lag(value) OVER w AS lag, lead(value) OVER w AS lead,
       dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS dense_rank
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def row_number_dense_lead(t):
    e = t.events.select("event_id", "ts", "user_id", "value")
    d = WD.row_features(e, "value", "ts", "event_id", ["user_id"]).withColumn("day", F.to_date("ts"))
    return WD.dense_rank_by(d, "day", ["user_id"]).select("event_id", "user_id", "rn", "lag", "lead", "dense_rank")


def day_text():
    return F.date_format("day", "yyyy-MM-dd").alias("day")


def lags(w):
    return ", ".join(f"lag(y, {n}) OVER {w} AS lag_{n}" for n in (1, 3, 7, 14, 30))


@query("lag_features", f"""
WITH {views.DAILY_BY_PRIORITY} SELECT strftime(day, '%Y-%m-%d') AS day, series, y, {lags("w")}
FROM dp WINDOW w AS (PARTITION BY series ORDER BY day)""")
def lag_features(t):
    return WD.lag_features(views.daily_by_priority(t), "y", [1, 3, 7, 14, 30], ["series"]).withColumn("day", day_text())


ROLL = ", ".join(f"""
CASE WHEN count(y) OVER w{n} >= 3 THEN round(avg(y) OVER w{n}, 4) END AS mean_{n},
CASE WHEN count(y) OVER w{n} >= 3 THEN round(stddev(y) OVER w{n}, 2) END AS std_{n}""" for n in (7, 14, 30))
ROLLW = ", ".join(f"w{n} AS (PARTITION BY series ORDER BY day ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
                  for n in (7, 14, 30))


@query("rolling_features", f"""
WITH {views.DAILY_BY_PRIORITY} SELECT strftime(day, '%Y-%m-%d') AS day, series, y, {ROLL} FROM dp WINDOW {ROLLW}""")
def rolling_features(t):
    d = WD.rolling_features(views.daily_by_priority(t), "y", [7, 14, 30], ["series"])
    return d.select(day_text(), "series", "y", *[F.round(c, 4 if c.startswith("mean_") else 2).alias(c)
                                              for c in d.columns if c.startswith(("mean_", "std_"))])


@query("momentum_ratio", f"""
WITH {views.DAILY_BY_PRIORITY} SELECT strftime(day, '%Y-%m-%d') AS day, series, round(y / (lag(y, 7) OVER w + 1e-8), 6) AS momentum
FROM dp WINDOW w AS (PARTITION BY series ORDER BY day)""")
def momentum_ratio(t):
    d = WD.momentum_ratio(views.daily_by_priority(t), "y", ["series"])
    return d.select(day_text(), "series", F.round("momentum", 6).alias("momentum"))


def _frame(back, ahead):
    return f"(ORDER BY day ROWS BETWEEN {back} PRECEDING AND {ahead} FOLLOWING)"


@query("trailing_mean", f"""
WITH {views.DAILY} SELECT strftime(day, '%Y-%m-%d') AS day,
  CASE WHEN count(y) OVER a = 20 THEN round(avg(y) OVER a, 4) END AS ma20,
  CASE WHEN count(y) OVER b = 50 THEN round(avg(y) OVER b, 4) END AS ma50
FROM daily WINDOW a AS {_frame(19, 0)}, b AS {_frame(49, 0)}""")
def trailing_mean(t):
    return views.daily_series(t).select(day_text(), F.round(WD.trailing_mean("y", 20, []), 4).alias("ma20"),
                                        F.round(WD.trailing_mean("y", 50, []), 4).alias("ma50"))


@query("centered_mean", f"""
WITH {views.DAILY} SELECT strftime(day, '%Y-%m-%d') AS day,
  CASE WHEN count(y) OVER a = 7 THEN round(avg(y) OVER a, 4) END AS c7,
  CASE WHEN count(y) OVER b = 30 THEN round(avg(y) OVER b, 4) END AS c30
FROM daily WINDOW a AS {_frame(3, 3)}, b AS {_frame(15, 14)}""")
def centered_mean(t):
    return views.daily_series(t).select(day_text(), F.round(WD.centered_mean("y", 7, []), 4).alias("c7"),
                                        F.round(WD.centered_mean("y", 30, []), 4).alias("c30"))


@query("diff_pct_change", f"""
WITH {views.DAILY} SELECT strftime(day, '%Y-%m-%d') AS day, round(y - lag(y) OVER w, 2) AS diff,
  round(y / lag(y) OVER w - 1, 6) AS pct_change FROM daily WINDOW w AS (ORDER BY day)""")
def diff_pct_change(t):
    d = WD.diff_pct(views.daily_series(t), "y", [])
    return d.select(day_text(), F.round("diff", 2).alias("diff"), F.round("pct_change", 6).alias("pct_change"))


@query("running_max_drawdown", f"""
WITH {views.DAILY_BY_PRIORITY}, p AS (SELECT *, max(y) OVER (PARTITION BY series ORDER BY day ROWS UNBOUNDED PRECEDING) AS peak FROM dp)
SELECT strftime(day, '%Y-%m-%d') AS day, series, peak, round((y - peak) / peak, 6) AS drawdown FROM p""")
def running_max_drawdown(t):
    d = WD.drawdown(views.daily_by_priority(t), "y", ["series"])
    return d.select(day_text(), "series", "peak", F.round("drawdown", 6).alias("drawdown"))


@query("relative_to_first", f"""
WITH {views.DAILY_BY_PRIORITY} SELECT strftime(day, '%Y-%m-%d') AS day, series,
  round((y / first_value(y) OVER (PARTITION BY series ORDER BY day) - 1) * 100, 6) AS change_pct FROM dp""")
def relative_to_first(t):
    d = WD.relative_to_first(views.daily_by_priority(t), "y", ["series"])
    return d.select(day_text(), "series", F.round("change_pct", 6).alias("change_pct"))


@query("avg_rank", """
WITH r AS (SELECT l_extendedprice, rank() OVER (ORDER BY l_extendedprice) AS rk,
                  count(*) OVER (PARTITION BY l_extendedprice) AS c FROM lineitem)
SELECT DISTINCT l_extendedprice, c AS cnt, rk + (c - 1) / 2 AS avg_rank FROM r""")
def avg_rank(t):
    return value_ranks(t.lineitem, "l_extendedprice").select("l_extendedprice", "cnt", "avg_rank")
