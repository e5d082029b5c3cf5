"""Scans, typed reads, table writes and read-backs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.plans.registry import query
from tallyframe.session import shared_path
from tallyframe.sources import sinks
from tallyframe.sources.tables import TABLE_NAMES, parse_dates


# The columns of the supplied tables.
COLUMNS = {
    'region': 'r_regionkey r_name',
    'nation': 'n_nationkey n_name n_regionkey',
    'customer': 'c_custkey c_name c_nationkey c_acctbal c_mktsegment',
    'supplier': 's_suppkey s_name s_nationkey s_acctbal',
    'part': 'p_partkey p_name p_brand p_type p_size p_retailprice',
    'orders': 'o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority',
    'lineitem': 'l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate',
    'events': 'event_id ts user_id event_type value props',
    'documents': 'doc_id text lang source n_chars',
    'embeddings': 'vec_id embedding label',
    'pages': 'page_id url html',
    'benchmark': 'item_id text',
    'labels': 'doc_id quality toxic',
    'conversations': 'conv_id turn role text',
}


def _scan_sql(table: str) -> str:
    values = " + ".join(f"count({c})" for c in COLUMNS[table].split())
    return f"SELECT '{table}' AS table_name, count(*) AS n_rows, {values} AS n_values FROM {table}"


@query("table_scan", " UNION ALL ".join(map(_scan_sql, TABLE_NAMES)))
def table_scan(t):
    """Every column of every table is read: rows, and values that are not null."""
    parts = []
    for n in TABLE_NAMES:
        d = getattr(t, n)
        values = reduce(lambda a, b: a + b, [F.count(c) for c in d.columns])
        parts.append(d.agg(F.count(F.lit(1)).alias("n_rows"), values.alias("n_values")).select(F.lit(n).alias("table_name"), "n_rows", "n_values"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("typed_read_dates", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS parsed, CAST(year(o_orderdate) AS INT) AS y
FROM orders""")
def typed_read_dates(t):
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    d = parse_dates(text, "d")
    return d.select("o_orderkey", F.date_format("d", "yyyy-MM-dd HH:mm:ss").alias("parsed"), F.year("d").alias("y"))


PART_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("category", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("stock", T.IntegerType(), True),
])


@query("create_table", """
SELECT p_partkey AS id, p_name AS name, p_type AS category, p_retailprice AS price,
       CASE WHEN p_size > 25 THEN p_size ELSE 0 END AS stock
FROM part""")
def create_table(t):
    insert = sinks.create_table(t.spark, shared_path(t.spark, "part"), PART_SCHEMA, {"stock": 0})
    return insert(t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"), F.when(F.col("p_size") > 25, F.col("p_size")).alias("stock"),
    ))


@query("integrity_check", """
SELECT 'pk_duplicates' AS check_name, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'fk_missing', count(*) FROM lineitem
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
UNION ALL SELECT 'not_null', CAST(coalesce(sum(CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)
FROM lineitem""")
def integrity_check(t):
    li = t.lineitem
    pk = li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("c")).agg(
        F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n")).select(F.lit("pk_duplicates").alias("check_name"), "n")
    # keys are counted first, so a hot order key is one row in the join
    keys = li.where("l_orderkey IS NOT NULL").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("c"))
    fk = keys.join(t.orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n")).select(F.lit("fk_missing").alias("check_name"), "n")
    nn = li.agg(F.coalesce(F.sum(F.col("l_quantity").isNull().cast("long")), F.lit(0)).alias("n")).select(
        F.lit("not_null").alias("check_name"), "n")
    return pk.unionByName(fk).unionByName(nn)


@query("insert_rows", """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT -1, 'Supplier#new', 3, 12.5 UNION ALL SELECT -2, 'Supplier#other', 4, 0.0""")
def insert_rows(t):
    return sinks.insert_rows(t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
                             [(-1, "Supplier#new", 3, 12.5), (-2, "Supplier#other", 4, 0.0)])


@query("write_csv", """
SELECT c_custkey, c_name, c_acctbal, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def write_csv(t):
    d = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "c_acctbal", "n_name")
    return sinks.write_csv(d, shared_path(t.spark, "customers"))


def month_report(t):
    return t.lineitem.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("l_extendedprice")).cast("long").alias("revenue"),
        F.round(F.avg("l_extendedprice"), 1).alias("mean_price"),
    )


MONTH_REPORT = """
SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n, CAST(round(sum(l_extendedprice)) AS BIGINT) AS revenue,
       round(avg(l_extendedprice), 1) AS mean_price
FROM lineitem GROUP BY 1"""


@query("replace_table", MONTH_REPORT)
def replace_table(t):
    path = shared_path(t.spark, "report")
    sinks.replace_table(month_report(t).where("n < 0"), path)
    return sinks.replace_table(month_report(t), path)


@query("write_json_log", """
SELECT o_orderpriority AS run, count(*) AS n_rows, round(avg(o_totalprice), 2) AS metric FROM orders GROUP BY 1""")
def write_json_log(t):
    runs = t.orders.groupBy(F.col("o_orderpriority").alias("run")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("o_totalprice"), 2).alias("metric"))
    return sinks.write_json_log(runs, shared_path(t.spark, "runs"))
