"""Text rows around a language model: render prompts, map a caller's function over rows, parse replies."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.text import first_block

REPLY = T.StructType([
    T.StructField("sentiment", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("priority", T.StringType()), T.StructField("_bad", T.StringType()),
])


def _parsed(c: Column) -> Column:
    p = F.from_json(c, REPLY, {"columnNameOfCorruptRecord": "_bad"})
    return F.when(p["_bad"].isNull() & c.startswith("{"), p)


def parse_reply(df: DataFrame, reply: str) -> DataFrame:
    """Whole text as JSON, else its first ``{...}`` block, else the defaults; missing fields get theirs."""
    d = df.withColumn("__p", F.coalesce(_parsed(F.trim(reply)), _parsed(first_block(F.col(reply)))))
    ok = F.col("__p").isNotNull()
    return d.withColumns({
        "sentiment": F.when(ok, F.coalesce("__p.sentiment", F.lit("?"))).otherwise("unknown"),
        "score": F.coalesce("__p.score", F.lit(0.5)),
        "priority": F.when(ok, F.coalesce("__p.priority", F.lit("?"))).otherwise("?"),
    }).drop("__p")


def model_map(df: DataFrame, prompt: str, complete: Callable[..., str], system: str = "", max_tokens: int = 1000,
              retries: int = 2, fallback: Callable[[str], str] | None = None) -> DataFrame:
    """Calls ``complete(prompt, system, max_tokens)`` per row inside the tasks.

    A call that still fails after the retries gets the fallback's reply and its error text.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("reply", T.StringType()), T.StructField("error", T.StringType())])

    def one(p):
        err = None
        for _ in range(retries + 1):
            try:
                return complete(p, system, max_tokens), None
            except Exception as e:  # noqa: BLE001  a caller's function may raise anything
                err = f"{type(e).__name__}: {e}"
        return (fallback(p) if fallback else None), err

    def run(batches):
        for pdf in batches:
            out = [one(p) for p in pdf[prompt]]
            yield pdf.assign(reply=pd.Series([o[0] for o in out], dtype=object, index=pdf.index),
                             error=pd.Series([o[1] for o in out], dtype=object, index=pdf.index))

    return df.mapInPandas(run, schema)


# Words that choose the offline reply, and the replies used when no model is given.
SENTIMENT_WORDS = ["sentiment", "hangulat"]
SUMMARY_WORDS = ["summary", "analyse", "összefoglaló", "elemezd"]
OFFLINE_SENTIMENT = '{"sentiment": "positive", "score": 0.85}'
OFFLINE_SUMMARY = "The data show a positive trend."
OFFLINE_OTHER = "[simulated reply]"


def offline_reply(prompt: Column) -> Column:
    """Rule-based reply as an expression; needs no Python at all."""
    p = F.lower(prompt)
    has = lambda words: reduce(lambda a, b: a | b, [p.contains(w) for w in words])
    return F.when(has(SENTIMENT_WORDS), OFFLINE_SENTIMENT).when(has(SUMMARY_WORDS), OFFLINE_SUMMARY).otherwise(OFFLINE_OTHER)


def rule_reply(prompt: Column) -> Column:
    """The reply by key words as a column expression; a null prompt gets the reply of other prompts."""
    low = F.lower(F.coalesce(prompt, F.lit("")))
    has = lambda words: reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])
    return F.when(has(SENTIMENT_WORDS), OFFLINE_SENTIMENT).when(has(SUMMARY_WORDS), OFFLINE_SUMMARY).otherwise(OFFLINE_OTHER)


def month_change(df: DataFrame, day: str, value: str) -> DataFrame:
    """Totals per month with the change to the month before in percent."""
    m = df.groupBy(F.date_format(day, "yyyy-MM").alias("month")).agg(F.sum(value).alias("total"))
    prev = F.lag("total").over(W.orderBy("month"))
    return m.withColumn("change_pct", (F.try_divide(F.col("total"), prev) - 1) * 100)


def anomaly_rows(series: DataFrame, width: int = 28, limit: float = 2.0, order: str = "day") -> DataFrame:
    """Change to the same weekday of last week and z-score against the trailing window (current row excluded)."""
    w = W.orderBy(order)
    back = w.rowsBetween(-width, -1)
    full = F.count("y").over(back) == width
    mean, sd = F.when(full, F.avg("y").over(back)), F.when(full, F.stddev_samp("y").over(back))
    prev = F.lag("y", 7).over(w)
    return series.withColumns({
        "drop_pct": (F.try_divide(F.col("y"), mean) - 1) * 100,
        "week_pct": (F.try_divide(F.col("y"), prev) - 1) * 100,
        "z": F.try_divide(F.col("y") - mean, sd),
    }).withColumn("is_anomaly", F.coalesce(F.abs("z") > limit, F.lit(False)))


def render(template: str, **cols: Column) -> Column:
    """Fills ``{name}`` places of a template with columns."""
    import re

    parts = re.split(r"(\{\w+\})", template)
    return F.concat(*[cols[p[1:-1]].cast("string") if re.fullmatch(r"\{\w+\}", p) else F.lit(p) for p in parts if p])
