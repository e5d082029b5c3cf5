"""Chat formatting: logged snapshots that another conversation continues are dropped, the others are rendered.

A prefix of a conversation is named by its length and two 64-bit values: the exclusive-or of hashes that contain
each turn's position. So prefix names are running values, which are built in blocks of turn numbers: a single
conversation with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyframe.session import checkpointed

BLOCK = 1024  # turn numbers in one block
PART = 64  # turns rendered into one row
KEYS = ["__c", "__b"]


def _carry(rows: DataFrame, values: dict[str, tuple[Column, callable]]) -> DataFrame:
    """Joins to each row what the earlier blocks of its conversation come to: ``name -> (column, aggregate)``."""
    per = rows.groupBy(*KEYS).agg(*[fn(c).alias(n) for n, (c, fn) in values.items()])
    before = W.partitionBy("__c").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("__c")
    base = per.select(*KEYS, *[F.coalesce(fn(F.col(n)).over(before), F.lit(0)).alias(f"{n}_before") for n, (_, fn) in values.items()],
                      *[fn(F.col(n)).over(whole).alias(f"{n}_all") for n, (_, fn) in values.items()])
    return rows.join(base, KEYS)


def numbered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, pos, n, role, text, p1, p2)``: position, number of turns, and the name of the prefix that ends here.

    Turns are ordered by number (null first), then role, then text; rows that are equal in all are turns of their
    own. Null role and text count as empty; rows with a null conv_id form one conversation.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # a struct is never null, so plain equality also joins the null conversation and keeps the windows' partitioning
    rows = rows.withColumn("__c", F.struct("conv_id")).withColumn("__b", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).cast("long"))
    order = W.partitionBy(*KEYS).orderBy("turn", "role", "text")
    rows = rows.withColumn("__r", F.row_number().over(order).cast("long"))
    rows = _carry(rows, {"__n": (F.lit(1).cast("long"), F.sum)})
    rows = rows.withColumn("pos", F.col("__r") + F.col("__n_before")).withColumn("n", F.col("__n_all"))
    rows = rows.withColumns({"__h1": F.xxhash64("pos", "role", "text"), "__h2": F.xxhash64(F.lit("second"), "pos", "role", "text")})
    upto = W.partitionBy(*KEYS).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rows = _carry(rows, {"__x1": (F.col("__h1"), F.bit_xor), "__x2": (F.col("__h2"), F.bit_xor)})
    name = lambda k: F.bit_xor(f"__h{k}").over(upto).bitwiseXOR(F.col(f"__x{k}_before"))
    return rows.select("conv_id", "pos", "n", "role", "text", name(1).alias("p1"), name(2).alias("p2"))


def maximal(rows: DataFrame) -> DataFrame:
    """``(conv_id, n, copies)``: conversations that no longer one begins with; of equal ones the smallest id, with their number."""
    name = ["n", "p1", "p2"]
    full = rows.where("pos = n").groupBy(*name).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    inner = rows.where("pos < n").select(F.col("pos").alias("n"), "p1", "p2").distinct()
    return full.join(inner, name, "left_anti").select("conv_id", "n", "copies")


def render(turns: DataFrame, part: int = PART, **columns) -> DataFrame:
    """``(conv_id, part, n_turns, copies, text)``: each maximal conversation in chat markup, ``part`` turns to a row.

    The conversation is its parts' texts in order. An empty table gives no rows.
    """
    rows = numbered(turns, **columns)
    names = checkpointed(rows.select("conv_id", "pos", "n", "p1", "p2"))
    kept = checkpointed(maximal(names)).withColumnRenamed("conv_id", "__kept").drop("n")
    body = F.concat(F.lit("<|im_start|>"), F.col("role"), F.lit("\n"), F.col("text"), F.lit("<|im_end|>\n"))
    rows = rows.join(kept, F.col("conv_id").eqNullSafe(F.col("__kept"))).select(
        "conv_id", "copies", "n", F.floor((F.col("pos") - 1) / part).cast("long").alias("part"), F.struct("pos", body.alias("t")).alias("x"))
    out = rows.groupBy("conv_id", "part").agg(F.first("n").alias("n_turns"), F.first("copies").alias("copies"), F.array_sort(F.collect_list("x")).alias("x"))
    return out.select("conv_id", "part", "n_turns", "copies", F.array_join(F.transform("x", lambda x: x["t"]), "").alias("text"))
