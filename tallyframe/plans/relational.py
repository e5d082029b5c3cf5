"""Projections, filters, sorts, limits, set work."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.operators import relational as R
from tallyframe.plans import views
from tallyframe.plans.registry import query


@query("filter_project_sort", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000
ORDER BY c_acctbal DESC, c_custkey""")
def filter_project_sort(t):
    return (t.customer.where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 5000))
            .select("c_custkey", "c_name", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey"))


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders ORDER BY 1")
def distinct_values(t):
    return t.orders.select("o_orderpriority").distinct().orderBy("o_orderpriority")


@query("chained_top_k", """
SELECT c_name, c_acctbal FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 0
ORDER BY c_acctbal DESC, c_custkey LIMIT 5""")
def chained_top_k(t):
    return (t.customer.where((F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") > 0))
            .orderBy(F.desc("c_acctbal"), "c_custkey").limit(5).select("c_name", "c_acctbal"))


@query("top_k_after_agg", """
SELECT l_partkey, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY 1
ORDER BY revenue DESC, l_partkey LIMIT 10""")
def top_k_after_agg(t):
    return (t.lineitem.groupBy("l_partkey")
            .agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
            .orderBy(F.desc("revenue"), "l_partkey").limit(10))


@query("mask_filter", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def mask_filter(t):
    return t.lineitem.where("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_quantity")


@query("slice_rows", """
WITH o AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn, count(*) OVER () AS n FROM events)
SELECT 'first' AS part, event_id FROM o WHERE rn <= 5
UNION ALL SELECT 'last', event_id FROM o WHERE rn > n - 5
UNION ALL SELECT 'every_2nd', event_id FROM o WHERE rn % 2 = 1""")
def slice_rows(t):
    e = t.events.select("event_id", "ts")
    first = R.head(e, 5, F.asc("ts"), F.asc("event_id")).select(F.lit("first").alias("part"), "event_id")
    last = R.head(e, 5, F.desc("ts"), F.desc("event_id")).select(F.lit("last").alias("part"), "event_id")
    second = R.every_nth(e, 2, "ts", "event_id").select(F.lit("every_2nd").alias("part"), "event_id")
    return first.unionByName(last).unionByName(second)


@query("select_by_dtype", """
SELECT sum(l_orderkey)::BIGINT AS l_orderkey, sum(l_partkey)::BIGINT AS l_partkey, sum(l_suppkey)::BIGINT AS l_suppkey,
       sum(l_linenumber)::BIGINT AS l_linenumber, round(sum(l_quantity), 2) AS l_quantity,
       round(sum(l_extendedprice), 2) AS l_extendedprice, round(sum(l_discount), 2) AS l_discount,
       round(sum(l_tax), 2) AS l_tax FROM lineitem""")
def select_by_dtype(t):
    d = t.lineitem
    whole = {"bigint", "int"}
    kinds = dict(d.dtypes)
    return d.agg(*[
        (F.sum(c) if kinds[c] in whole else F.round(F.sum(c), 2)).alias(c) for c in R.numeric_columns(d)])


@query("drop_null_rows", f"""
WITH {views.DIRTY_EVENTS} SELECT event_id, user_id, event_type, value FROM de WHERE value IS NOT NULL""")
def drop_null_rows(t):
    return views.dirty_events(t).na.drop().select("event_id", "user_id", "event_type", "value")


@query("union_all", """
WITH a AS (SELECT l_returnflag, l_quantity FROM lineitem),
b AS (SELECT l_returnflag, l_quantity FROM lineitem WHERE l_quantity > 40)
SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS q FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1""")
def union_all(t):
    a = t.lineitem.select("l_returnflag", "l_quantity")
    return a.unionByName(a.where("l_quantity > 40")).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))


@query("duplicate_count", """
SELECT sum(c)::BIGINT AS n_rows, count(*) AS n_distinct, sum(c - 1)::BIGINT AS n_duplicates
FROM (SELECT count(*) AS c FROM documents GROUP BY text)""")
def duplicate_count(t):
    return R.duplicate_count(t.documents.select(F.sha2("text", 256).alias("digest")))


@query("drop_duplicates", """
SELECT doc_id, lang, source, n_chars FROM documents d WHERE doc_id = (SELECT min(doc_id) FROM documents e WHERE e.text = d.text)""")
def drop_duplicates(t):
    # the digest of the whole text is the key, so whole texts are not shuffled
    d = t.documents.withColumn("digest", F.sha2("text", 256)).select("digest", "doc_id", "lang", "source", "n_chars")
    return R.first_per_key(d, ["digest"], ["doc_id"]).drop("digest")


@query("seeded_shuffle_sample", """
SELECT c_custkey, c_name FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 20""")
def seeded_shuffle_sample(t):
    return t.customer.orderBy(F.md5(F.col("c_custkey").cast("string")), "c_custkey").limit(20).select(
        "c_custkey", "c_name")


@query("dict_lookup", """
SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'size' WHEN 'MEDIUM' THEN 'size' WHEN 'LARGE' THEN 'size'
  WHEN 'PROMO' THEN 'PROMO' ELSE 'other' END AS part_group FROM part""")
def dict_lookup(t):
    g = R.lookup(F.col("p_type"), {"SMALL": "size", "MEDIUM": "size", "LARGE": "size"}, ["PROMO"], "other")
    return t.part.select("p_partkey", g.alias("part_group"))


@query("collection_ops", """
WITH x AS (SELECT doc_id, string_split(replace(text, chr(10), ' '), ' ') AS ws FROM documents)
SELECT doc_id,
       CAST(len(ws) AS INT) AS n_words,
       CAST(len(list_distinct(ws)) AS INT) AS n_distinct,
       array_to_string(list_sort(list_distinct(ws))[1:3], '|') AS first_sorted,
       CAST(coalesce(list_max(list_transform(ws, lambda w: length(w))), 0) AS INT) AS longest,
       CAST(list_sum(list_transform(list_filter(list_transform(ws, lambda w: length(w)), lambda n: n % 2 = 0), lambda n: n * n)) AS BIGINT)
         AS even_squares
FROM x""")
def collection_ops(t):
    x = t.documents.select("doc_id", F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ").alias("ws"))
    x = x.select("*", F.array_sort(F.array_distinct("ws")).alias("u"), F.transform("ws", F.length).alias("ls"))
    even = F.filter("ls", lambda n: n % 2 == 0)
    return x.select(
        "doc_id", F.size("ws").alias("n_words"), F.size("u").alias("n_distinct"),
        F.array_join(F.slice("u", 1, 3), "|").alias("first_sorted"),
        F.array_max("ls").alias("longest"),
        F.when(F.size(even) > 0, F.aggregate(even, F.lit(0).cast("long"), lambda s, n: s + n * n)).alias("even_squares"),
    )


@query("elementwise_broadcast", """
SELECT event_id, round(value * 9 / 5 + 32, 4) AS fahrenheit, abs(value - 50) AS dist FROM events""")
def elementwise_broadcast(t):
    return t.events.select(
        "event_id", F.round(F.col("value") * 9 / 5 + 32, 4).alias("fahrenheit"), F.abs(F.col("value") - 50).alias("dist"))
