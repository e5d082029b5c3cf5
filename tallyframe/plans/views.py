"""Derived inputs shared by the queries, each as a DataFrame and as the equal SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.sources.tables import Tables, spread

DIRTY_LINEITEM_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"]


def dirty_lineitem(t: Tables) -> DataFrame:
    """Line items with injected nulls, inflated prices and repeated rows."""
    d = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 10 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_orderkey") % 97 == 0, F.col("l_extendedprice") * 10)
        .otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(F.col("l_orderkey") % 13 != 0, F.col("l_discount")).alias("l_discount"),
        "l_returnflag",
    )
    return d.unionByName(d.where(F.col("l_orderkey") % 25 == 0))


DIRTY_LINEITEM = """
dl0 AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 10 <> 0 THEN l_quantity END AS l_quantity,
         CASE WHEN l_orderkey % 97 = 0 THEN l_extendedprice * 10 ELSE l_extendedprice END AS l_extendedprice,
         CASE WHEN l_orderkey % 13 <> 0 THEN l_discount END AS l_discount,
         l_returnflag
  FROM lineitem),
dl AS (SELECT * FROM dl0 UNION ALL SELECT * FROM dl0 WHERE l_orderkey % 25 = 0)
"""


def dirty_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
    )


DIRTY_ORDERS = """
dorders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS o_totalprice, o_orderdate,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_orderpriority
  FROM orders)
"""


def dirty_customer(t: Tables) -> DataFrame:
    seg, k = F.col("c_mktsegment"), F.col("c_custkey") % 5
    return t.customer.select(
        "c_custkey", "c_nationkey", "c_acctbal",
        F.when(F.col("c_custkey") % 23 == 0, None)
        .when(k == 0, F.lower(seg)).when(k == 1, F.upper(seg)).when(k == 2, F.concat(F.lit("  "), seg, F.lit(" ")))
        .when(k == 3, F.substring(seg, 1, F.length(seg) - 1)).otherwise(seg).alias("segment"),
        F.when(F.col("c_custkey") % 19 == 0, F.lit("n/a"))
        .otherwise(F.concat(F.floor("c_acctbal").cast("long").cast("string"), F.lit(" Ft"))).alias("balance_text"),
    )


DIRTY_CUSTOMER = """
dc AS (
  SELECT c_custkey, c_nationkey, c_acctbal,
         CASE WHEN c_custkey % 23 = 0 THEN NULL
              WHEN c_custkey % 5 = 0 THEN lower(c_mktsegment)
              WHEN c_custkey % 5 = 1 THEN upper(c_mktsegment)
              WHEN c_custkey % 5 = 2 THEN '  ' || c_mktsegment || ' '
              WHEN c_custkey % 5 = 3 THEN substring(c_mktsegment, 1, length(c_mktsegment) - 1)
              ELSE c_mktsegment END AS segment,
         CASE WHEN c_custkey % 19 = 0 THEN 'n/a'
              ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) || ' Ft' END AS balance_text
  FROM customer)
"""


def dirty_events(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", "ts", "user_id", "event_type",
        F.when(F.col("event_id") % 9 != 0, F.col("value")).alias("value"),
    )


DIRTY_EVENTS = """
de AS (SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 9 <> 0 THEN value END AS value FROM events)
"""


def daily_series(t: Tables) -> DataFrame:
    """One row per order day; its size is bounded by the calendar, not by the orders."""
    return t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.round(F.sum("o_totalprice"), 2).alias("y"))


DAILY = """
daily AS (SELECT CAST(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 2) AS y FROM orders GROUP BY 1)
"""


def daily_by_priority(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("series")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("y")
    )


DAILY_BY_PRIORITY = """
dp AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS series, round(sum(o_totalprice), 2) AS y
       FROM orders GROUP BY 1, 2)
"""


def gap_series(t: Tables) -> DataFrame:
    """Daily totals on a full calendar; missing days and every 37th day read 0."""
    s = daily_series(t)
    span = s.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    cal = span.select(F.explode(F.sequence("a", "b")).alias("day"), "a")
    return cal.join(s, "day", "left").select(
        "day",
        F.when(F.datediff("day", "a") % 37 == 0, F.lit(0.0)).otherwise(F.coalesce("y", F.lit(0.0))).alias("y"),
    )


GAP = DAILY + """,
span AS (SELECT min(day) AS a, max(day) AS b FROM daily),
cal AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day, a FROM span),
gap AS (SELECT cal.day, CASE WHEN date_diff('day', a, cal.day) % 37 = 0 THEN 0.0 ELSE coalesce(y, 0.0) END AS y
        FROM cal LEFT JOIN daily ON cal.day = daily.day)
"""

DRIFT_CUT = "1998-01-01"


def drift_pair(t: Tables) -> DataFrame:
    """Line items marked as reference (shipped before the cut) or production."""
    return t.lineitem.select(
        (F.col("l_shipdate") >= F.lit(DRIFT_CUT).cast("timestamp_ntz")).alias("is_prod"),
        "l_extendedprice", "l_quantity", "l_discount",
    )


DRIFT = f"""
drift AS (SELECT l_shipdate >= TIMESTAMP '{DRIFT_CUT}' AS is_prod, l_extendedprice, l_quantity, l_discount
          FROM lineitem)
"""


def replies(t: Tables) -> DataFrame:
    """Model replies made from events: clean JSON, JSON inside prose, or text without JSON."""
    js = F.concat(
        F.lit('{"sentiment": "'), "event_type", F.lit('", "score": '), F.col("value").cast("string"), F.lit("}")
    )
    k = F.col("event_id") % 3
    return t.events.select(
        "event_id",
        F.when(k == 0, js).when(k == 1, F.concat(F.lit("Here it is:\n"), js, F.lit("\nDone.")))
        .otherwise(F.concat(F.lit("no answer for "), "event_type")).alias("reply"),
    )


REPLIES = """
rp AS (
  SELECT event_id, event_type, value,
         CASE WHEN event_id % 3 = 0 THEN '{"sentiment": "' || event_type || '", "score": ' || CAST(value AS VARCHAR) || '}'
              WHEN event_id % 3 = 1 THEN 'Here it is:' || chr(10) || '{"sentiment": "' || event_type || '", "score": '
                   || CAST(value AS VARCHAR) || '}' || chr(10) || 'Done.'
              ELSE 'no answer for ' || event_type END AS reply
  FROM events)
"""


def label_features(t: Tables) -> DataFrame:
    """Shape features of each labelled document. One text scan, one join on doc_id."""
    n = F.length("text")
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    count = lambda pat: F.length(F.regexp_replace("text", pat, ""))
    f = spread(t.documents).select(
        "doc_id", "lang",
        F.col("n_chars").cast("double").alias("n_chars"),
        words.cast("double").alias("n_words"),
        (n / F.greatest(words, F.lit(1))).alias("mean_word"),
        (count("[^0-9]") / F.greatest(n, F.lit(1))).alias("digit_share"),
        (count("[^A-Z]") / F.greatest(n, F.lit(1))).alias("upper_share"),
        (count("[^.,;:!?]") / F.greatest(n, F.lit(1))).alias("punct_share"),
    )
    return t.labels.join(f, "doc_id").select(*f.columns, "quality", "toxic")


FEATURE_COLUMNS = ["n_chars", "n_words", "mean_word", "digit_share", "upper_share", "punct_share"]


def trade_graph(t: Tables) -> DataFrame:
    """Nations as nodes; an edge joins two nations whose mutual trade is above the mean pair's.

    Line items are summed per nation pair before anything else, so the graph is
    bounded by the number of nations while the work is a scan of all line items.
    """
    li = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_extendedprice").alias("v"))
    li = li.join(t.orders.select("o_orderkey", "o_custkey"), li.l_orderkey == F.col("o_orderkey"))
    li = li.groupBy("o_custkey", "l_suppkey").agg(F.sum("v").alias("v"))
    li = li.join(t.customer.select("c_custkey", "c_nationkey"), li.o_custkey == F.col("c_custkey"))
    li = li.join(t.supplier.select("s_suppkey", "s_nationkey"), li.l_suppkey == F.col("s_suppkey"))
    pairs = li.where("c_nationkey <> s_nationkey").groupBy(
        F.least("c_nationkey", "s_nationkey").cast("long").alias("u"),
        F.greatest("c_nationkey", "s_nationkey").cast("long").alias("v_"),
    ).agg(F.sum("v").alias("trade"))
    mean = pairs.agg(F.avg("trade")).scalar()
    return pairs.where(F.col("trade") > mean).select("u", F.col("v_").alias("v"))


TRADE = """
tpairs AS (
  SELECT CAST(least(c_nationkey, s_nationkey) AS BIGINT) AS u, CAST(greatest(c_nationkey, s_nationkey) AS BIGINT) AS v,
         sum(l_extendedprice) AS trade
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
  WHERE c_nationkey <> s_nationkey GROUP BY 1, 2),
g AS (SELECT u, v FROM tpairs WHERE trade > (SELECT avg(trade) FROM tpairs)),
gg AS (SELECT u AS a, v AS b FROM g UNION ALL SELECT v, u FROM g)
"""


def market_graph(t: Tables) -> DataFrame:
    """Customers, suppliers and nations as nodes of one graph whose edges grow with the rows.

    Edges: customer - supplier (bought from), customer - nation, supplier - nation.
    Node numbers: nation n -> 3n, customer c -> 3c + 1, supplier s -> 3s + 2.
    """
    li = t.lineitem.select("l_orderkey", "l_suppkey")  # repeats go after the join, in one shuffle
    bought = li.join(t.orders.select("o_orderkey", "o_custkey"), li.l_orderkey == F.col("o_orderkey")).select(
        (F.col("o_custkey") * 3 + 1).alias("x"), (F.col("l_suppkey") * 3 + 2).alias("y")
    ).distinct()
    home_c = t.customer.select((F.col("c_custkey") * 3 + 1).alias("x"),
                               (F.col("c_nationkey").cast("long") * 3).alias("y"))
    home_s = t.supplier.select((F.col("s_suppkey") * 3 + 2).alias("x"),
                               (F.col("s_nationkey").cast("long") * 3).alias("y"))
    e = bought.unionByName(home_c).unionByName(home_s)
    return e.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))


MARKET = """
m0 AS (
  SELECT DISTINCT o_custkey * 3 + 1 AS x, l_suppkey * 3 + 2 AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT c_custkey * 3 + 1, CAST(c_nationkey AS BIGINT) * 3 FROM customer
  UNION ALL SELECT s_suppkey * 3 + 2, CAST(s_nationkey AS BIGINT) * 3 FROM supplier),
g AS (SELECT least(x, y) AS u, greatest(x, y) AS v FROM m0),
gg AS (SELECT u AS a, v AS b FROM g UNION ALL SELECT v, u FROM g)
"""


def home_graph(t: Tables) -> DataFrame:
    """Customers, suppliers and nations with one link per customer to its main supplier, and one per customer and supplier
    to its nation: a sparse graph whose nodes and edges grow with the rows. Node numbers as in ``market_graph``.

    The main supplier is the one with most lines (ties: the smallest key).
    """
    li = t.lineitem.select("l_orderkey", "l_suppkey")  # orders are much fewer: lines are shuffled once for the join, then counted
    per = li.join(t.orders.select("o_orderkey", "o_custkey"), li.l_orderkey == F.col("o_orderkey"))
    per = per.groupBy("o_custkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    main = per.groupBy("o_custkey").agg(F.min(F.struct(-F.col("n"), F.col("l_suppkey").alias("s"))).alias("m"))
    main = main.select((F.col("o_custkey") * 3 + 1).alias("x"), (F.col("m.s") * 3 + 2).alias("y"))
    home_c = t.customer.select((F.col("c_custkey") * 3 + 1).alias("x"), (F.col("c_nationkey").cast("long") * 3).alias("y"))
    home_s = t.supplier.select((F.col("s_suppkey") * 3 + 2).alias("x"), (F.col("s_nationkey").cast("long") * 3).alias("y"))
    e = main.unionByName(home_c).unionByName(home_s)
    return e.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))


HOME = """
hp AS (SELECT o_custkey, l_suppkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
h0 AS (
  SELECT o_custkey * 3 + 1 AS x, l_suppkey * 3 + 2 AS y FROM hp QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, l_suppkey) = 1
  UNION ALL SELECT c_custkey * 3 + 1, CAST(c_nationkey AS BIGINT) * 3 FROM customer
  UNION ALL SELECT s_suppkey * 3 + 2, CAST(s_nationkey AS BIGINT) * 3 FROM supplier),
g AS (SELECT least(x, y) AS u, greatest(x, y) AS v FROM h0),
gg AS MATERIALIZED (SELECT u AS a, v AS b FROM g UNION ALL SELECT v, u FROM g)
"""


def customer_points(t: Tables) -> DataFrame:
    """Customers as two standard-scaled numbers: balance and total of their orders."""
    spent = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("spent"))
    p = t.customer.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("a"), F.coalesce("spent", F.lit(0.0)).alias("b")
    )
    from tallyframe.operators.features import standard_scale

    return standard_scale(p, ["a", "b"]).select("id", F.round("a", 6).alias("x"), F.round("b", 6).alias("y"))


POINTS = """
pts0 AS (SELECT c_custkey AS id, c_acctbal AS a, coalesce(spent, 0.0) AS b FROM customer LEFT JOIN
         (SELECT o_custkey, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY 1) ON c_custkey = o_custkey),
pstat AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM pts0),
pts AS (SELECT id, round((a - ma) / sa, 6) AS x, round((b - mb) / sb, 6) AS y FROM pts0, pstat)
"""
