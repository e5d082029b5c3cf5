"""Secret scans: strong patterns, and weak candidates reported only where complementary parts stand together.

Everything on the way is column expressions. A pattern gives its matches in order and the text between them
(``split`` uses the same matching), so positions are running sums of lengths in code points. Weak parts are
account names, bare key values and endpoints; they meet in an interval join: parts are filed in every bin they
touch, and since a bin is as wide as the reach, a part's own bins and the last end before and the first start after
them decide exactly, without pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.common import let
from tallyframe.session import checkpointed

REACH = 200  # code points between the end of a part and the start of the next in one scope

# The base patterns (kind, expression, group whose length counts, least length).
ASSIGN = ("(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12)
ACCESS = ("AKIA[A-Z0-9]{14,}", 0, 18)  # a run too short to count has no longer one inside
HEX = ("[0-9a-f]{16,}", 0, 16)  # maximal runs, as any shorter run is skipped whole
# Weak parts: reported only with a complement in reach.
USER = ("(?i)(?:user(?:name|id)?|login|account|client_?id|access_?id)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9@+/_.-]{3,})", 1, 3)
VALUE = ("(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{20})(?=[A-Za-z+/_-]*+[0-9])(?=[a-z0-9+/_-]*+[A-Z])(?=[A-Z0-9+/_-]*+[a-z])"
         "[A-Za-z0-9+/_-]{20,}", 0, 20)
ENDPOINT = ("(?i)[a-z][a-z0-9+.-]{1,15}://[^\\s\"'<>]{3,}", 0, 8)

BASE = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
WEAK = {"user": USER, "value": VALUE, "endpoint": ENDPOINT}
KINDS = [*BASE, *WEAK]
#: Which kinds complete a weak one: a name needs a secret, a bare value a name or an endpoint, an endpoint a secret and a name.
SECRETS = ("assign", "value", "hex")
NAMES = ("access", "user")
SPAN = "array<struct<start:long,kind:int,end:long>>"


def running(lens: Column) -> Column:
    """Sums before each element of an int array: blocks of about the square root of its size, so no quadratic copying."""
    return let(lens, _running)


def _running(lens: Column) -> Column:
    size = F.greatest(F.ceil(F.sqrt(F.size(lens))).cast("int"), F.lit(1))
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(lens) - 1) / size), F.lit(0)).cast("int")),
                         lambda k: F.slice(lens, k * size + 1, size))
    zero = F.lit(0).cast("long")
    scan = lambda xs: F.aggregate(
        xs, F.struct(zero.alias("at"), F.array().cast("array<long>").alias("out")),
        lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]
    totals = lambda bs: F.transform(bs, lambda b: F.aggregate(b, zero, lambda acc, x: acc + x))
    return let(blocks, lambda bs: F.flatten(F.zip_with(bs, scan(totals(bs)), lambda b, base: F.transform(scan(b), lambda x: x + base))))


def spans_of(text: Column, kind: int, spec: tuple[str, int, int]) -> Column:
    """Kept matches of a pattern as spans; texts without a match cost one search."""
    pattern, group, least = spec
    none = F.array().cast(SPAN)

    def place(m: Column) -> Column:
        counted = m if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        lens = lambda xs: F.transform(xs, lambda x: F.length(x).cast("long"))
        return let(F.struct(lens(m).alias("n"), lens(counted).alias("c"), lens(F.slice(F.split(text, pattern, -1), 1, F.size(m))).alias("g")), made)

    def made(x: Column) -> Column:
        at = running(F.zip_with(x["g"], x["n"], lambda g, n: g + n))
        rows = F.arrays_zip(at.alias("a"), x["g"].alias("g"), x["n"].alias("n"), x["c"].alias("c"))
        kept = F.filter(rows, lambda r: r["c"] >= least)
        return F.transform(kept, lambda r: F.struct((r["a"] + r["g"]).alias("start"), F.lit(kind).alias("kind"), (r["a"] + r["g"] + r["n"]).alias("end"))).cast(SPAN)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, place(m)).otherwise(none))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """``(doc_id, h, base, linked)``: spans of the base kinds and of the weak parts that found their complement.

    Spans are ``(start, kind, end)`` in code points, sorted, end exclusive; ``kind`` indexes KINDS. ``h`` is the hash
    of the text: links are made per text and id. A null text counts as empty and has no spans. Repeated rows each
    get their spans. Other columns are not read.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("h"), t.alias("t"))
    found = base.select("doc_id", "h", F.array_sort(F.concat(*[spans_of(F.col("t"), k, BASE[n]) for k, n in enumerate(BASE)])).alias("base"),
                        F.concat(*[spans_of(F.col("t"), len(BASE) + k, WEAK[n]) for k, n in enumerate(WEAK)]).alias("weak"))
    found = checkpointed(found)
    key = F.struct(F.col("doc_id").isNull().alias("n"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")).alias("d"), F.col("h"))
    parts = found.where(F.size("weak") > 0).select(key.alias("key"), F.explode(F.concat("base", "weak")).alias("s"))
    touched = F.sequence((F.col("s.start") / reach).cast("long"), (F.col("s.end") / reach).cast("long"))
    parts = parts.distinct().select("key", F.explode(touched).alias("bin"), "s")
    kinds = lambda names: F.col("s.kind").isin([KINDS.index(n) for n in names])
    group = {"secret": kinds(SECRETS), "name": kinds(NAMES), "endpoint": kinds(("endpoint",))}
    bins = parts.groupBy("key", "bin").agg(*[e for g, c in group.items() for e in (
        F.min(F.when(c, F.col("s.start"))).alias(f"{g}_lo"), F.max(F.when(c, F.col("s.end"))).alias(f"{g}_hi"))])
    # every bin tells itself and its two neighbours how near its parts come
    near = bins.select("key", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("off"), F.col("bin").alias("from"), *[f"{g}_{e}" for g in group for e in ("lo", "hi")])
    near = near.groupBy("key", (F.col("from") + F.col("off")).alias("bin")).agg(*[e for g in group for e in (
        F.max(F.when(F.col("off") == 1, F.col(f"{g}_hi"))).alias(f"{g}_before"),
        F.max(F.when(F.col("off") == 0, F.col(f"{g}_hi"))).alias(f"{g}_same"),
        F.min(F.when(F.col("off") == -1, F.col(f"{g}_lo"))).alias(f"{g}_after"))])
    s = F.col("s")
    close = lambda g: F.coalesce(F.col(f"{g}_same").isNotNull() | (F.col(f"{g}_before") >= s["start"] - reach) | (F.col(f"{g}_after") <= s["end"] + reach), F.lit(False))
    weak = parts.where(s["kind"] >= len(BASE)).join(near, ["key", "bin"]).groupBy("key", "s").agg(*[F.max(close(g)).alias(g) for g in group])
    complete = (F.when(s["kind"] == KINDS.index("user"), F.col("secret"))
                .when(s["kind"] == KINDS.index("value"), F.col("name") | F.col("endpoint"))
                .otherwise(F.col("secret") & F.col("name")))
    linked = weak.where(complete).groupBy("key").agg(F.array_sort(F.collect_set("s")).alias("linked"))
    out = found.withColumn("key", key).join(linked, "key", "left")
    return out.select("doc_id", "h", "base", F.coalesce("linked", F.array().cast(SPAN)).alias("linked"))


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def report(scanned: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans as text."""
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scanned.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                          F.sha2(_text(F.col("base")), 256).alias("base_sha256"),
                          _text(F.array_sort(F.concat("base", "linked"))).alias("spans"))


MASK = "[SECRET]"


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """The documents with every span cut out for a mask; all columns as they came, no document is dropped.

    ``n_chars``, where there is such a column, is the length of the new text. Overlapping spans are merged.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = scan(docs, doc_id, text, reach).where((F.size("base") > 0) | (F.size("linked") > 0))
    spans = checkpointed(found.groupBy("doc_id", "h").agg(F.first(F.array_sort(F.concat("base", "linked"))).alias("__s"))
                         .withColumnsRenamed({"doc_id": "__d", "h": "__h"}))
    merged = F.aggregate(
        "__s", F.array().cast("array<struct<a:long,b:long>>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["b"] >= s["start"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.try_element_at(acc, F.lit(-1))["a"].alias("a"),
                                  F.greatest(F.try_element_at(acc, F.lit(-1))["b"], s["end"]).alias("b")))))
        .otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("a"), s["end"].alias("b"))))))
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("__m", lambda m: m["b"]))
    ends = F.concat(F.transform("__m", lambda m: m["a"]), F.array(F.length("__t").cast("long")))
    cut = F.array_join(F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")),
                                   lambda x: F.substring(F.col("__t"), (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int"))), MASK)
    joined = docs.withColumns({"__t": t, "__k": F.xxhash64(t)}).join(
        spans, (F.col("__k") == F.col("__h")) & F.col(doc_id).eqNullSafe(F.col("__d")), "left").withColumn("__m", merged)
    new = F.when(F.col("__s").isNull(), F.col(text)).otherwise(cut)
    out = joined.withColumn("__new", new)
    pick = lambda c: (F.col("__new").alias(c) if c == text else
                      F.when(F.col("__s").isNull(), F.col(c)).otherwise(F.length("__new")).cast(docs.schema[c].dataType).alias(c)
                      if c == "n_chars" and isinstance(docs.schema[c].dataType, T.IntegralType) else F.col(f"`{c}`"))
    return out.select(*[pick(c) for c in docs.columns])
