"""Scalar function families."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import text as FT
from tallyframe.plans.registry import query


@query("string_functions", """
SELECT p_partkey, upper(p_name) AS up,
       upper(substring(p_name, 1, 1)) || substring(split_part(p_name, ' ', 1), 2) || ' '
         || upper(substring(split_part(p_name, ' ', 2), 1, 1)) || substring(split_part(p_name, ' ', 2), 2) AS title,
       trim('  ' || p_brand || ' ') AS trimmed, replace(p_brand, 'Brand#', '') AS brand_no,
       array_to_string(string_split(p_name, ' '), '-') AS joined, substring(p_name, 1, 5) || '...' AS short,
       CAST(length(p_name) AS INT) AS len, contains(p_name, 'ring') AS has_ring,
       format('{:,}', CAST(round(p_retailprice) AS BIGINT)) AS money,
       CAST(CAST(round(p_size / 50.0 * 100) AS BIGINT) AS VARCHAR) || '%' AS pct
FROM part""")
def string_functions(t):
    n = F.col("p_name")
    return t.part.select(
        "p_partkey", F.upper(n).alias("up"), F.initcap(n).alias("title"),
        F.trim(F.concat(F.lit("  "), "p_brand", F.lit(" "))).alias("trimmed"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).alias("brand_no"),
        F.array_join(F.split(n, " "), "-").alias("joined"), FT.preview(n, 5).alias("short"),
        F.length(n).alias("len"), n.contains("ring").alias("has_ring"),
        F.format_number(F.round("p_retailprice"), 0).alias("money"), FT.percent_text(F.col("p_size") / 50.0).alias("pct"))


@query("regex_functions", r"""
SELECT doc_id, CAST(length(regexp_replace(lower(text), '[^a-záéíóöőúüű\s]', ' ', 'g')) AS BIGINT) AS n,
       md5(regexp_replace(lower(text), '[^a-záéíóöőúüű\s]', ' ', 'g')) AS digest,
       regexp_extract('x' || chr(10) || '{"n": ' || n_chars || chr(10) || '} y', '(?s)\{.*\}') AS block
FROM documents""")
def regex_functions(t):
    c = FT.letters_only(F.col("text"))
    wrapped = F.concat(F.lit('x\n{"n": '), F.col("n_chars").cast("string"), F.lit("\n} y"))
    return t.documents.select("doc_id", F.length(c).cast("long").alias("n"), F.md5(c).alias("digest"),
                              FT.first_block(wrapped).alias("block"))


@query("date_functions", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m,
       CAST(isodow(o_orderdate) - 1 AS INT) AS wd, CAST(dayofyear(o_orderdate) AS INT) AS doy,
       CAST(week(o_orderdate) AS INT) AS iso_week, CAST(quarter(o_orderdate) AS INT) AS q,
       strftime(o_orderdate, '%Y-%m') AS period, strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS plus30
FROM orders""")
def date_functions(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), F.weekday(d).alias("wd"),
        F.dayofyear(d).alias("doy"), F.weekofyear(d).alias("iso_week"), F.quarter(d).alias("q"),
        F.date_format(d, "yyyy-MM").alias("period"), F.date_format(F.date_add(d, 30), "yyyy-MM-dd").alias("plus30"))


@query("math_functions", """
SELECT l_orderkey, l_linenumber, l_quantity * l_quantity AS sq, round(sqrt(l_quantity), 6) AS root,
       round(ln(1 + l_extendedprice), 6) AS lg, round(exp(l_discount), 6) AS ex, round(sin(l_quantity), 6) AS si,
       round(cos(l_quantity), 6) AS co, abs(l_quantity - 25) AS ab, round(l_extendedprice, 1) AS ro,
       least(greatest(l_quantity, 5), 45) AS clipped, CAST(CASE WHEN l_quantity > 25 THEN 1 ELSE -1 END AS INT) AS sg
FROM lineitem""")
def math_functions(t):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", (q * q).alias("sq"), F.round(F.sqrt(q), 6).alias("root"),
        F.round(F.log1p("l_extendedprice"), 6).alias("lg"), F.round(F.exp("l_discount"), 6).alias("ex"),
        F.round(F.sin(q), 6).alias("si"), F.round(F.cos(q), 6).alias("co"), F.abs(q - 25).alias("ab"),
        F.round("l_extendedprice", 1).alias("ro"), F.least(F.greatest(q, F.lit(5.0)), F.lit(45.0)).alias("clipped"),
        F.when(q > 25, 1).otherwise(-1).alias("sg"))


@query("conversion_null_functions", """
WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'n/a' ELSE ' ' || CAST(p_size AS VARCHAR) || ' ' END AS s,
                  p_size FROM part)
SELECT p_partkey, TRY_CAST(trim(s) AS DOUBLE) AS num, TRY_CAST(trim(s) AS DOUBLE) IS NULL AS is_null,
       coalesce(TRY_CAST(trim(s) AS DOUBLE), -1) AS filled, nullif(p_size, 50) AS no50, CAST(p_size AS VARCHAR) AS txt FROM x""")
def conversion_null_functions(t):
    s = F.when(F.col("p_partkey") % 7 == 0, F.lit("n/a")).otherwise(
        F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" ")))
    num = F.trim(s).try_cast("double")
    return t.part.select(
        "p_partkey", num.alias("num"), num.isNull().alias("is_null"), F.coalesce(num, F.lit(-1.0)).alias("filled"),
        F.nullif("p_size", F.lit(50)).alias("no50"), F.col("p_size").cast("string").alias("txt"))


@query("json_functions", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       coalesce(json_extract_string(props, '$.missing'), '?') AS missing,
       CASE WHEN json_valid(props || CASE WHEN event_id % 10 = 0 THEN 'x}' ELSE '' END)
            THEN CAST(json_extract_string(props, '$.k') AS BIGINT) ELSE -1 END AS k_or_default,
       '{"type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS out
FROM events""")
def json_functions(t):
    schema = T.StructType([T.StructField("k", T.LongType())])
    # a damaged text must fall back to the default as a whole, so it may not parse in part
    damaged = F.concat(F.when(F.col("event_id") % 10 == 0, F.lit("x")).otherwise(""), "props")
    return t.events.select(
        "event_id", F.from_json("props", schema)["k"].alias("k"),
        F.coalesce(F.get_json_object("props", "$.missing"), F.lit("?")).alias("missing"),
        F.coalesce(F.from_json(damaged, schema)["k"], F.lit(-1).cast("long")).alias("k_or_default"),
        F.to_json(F.struct(F.col("event_type").alias("type"), F.get_json_object("props", "$.k").cast("long").alias("k")))
        .alias("out"))
