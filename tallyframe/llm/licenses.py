"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Windows come in classes, as long as twice the templates of the class and half overlapping, so a template stands
whole in one window and is at least a quarter of it. With one row to a band, the chance that none of the bands
meets is ``(1 - j)^bands`` for similarity j: with 32 bands below one in a thousand even at four fifths of a template.
"""

from __future__ import annotations

import math
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import let
from tallyframe.session import checkpointed

SHINGLE = 5
BANDS = 32
CONTAINMENT = 0.8

# Short notices as projects print them, first sentences of longer ones, standard headers.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files (the \"Software\"), to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                 "the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
                         "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                         "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    # so short that another family or version leaves less than 0.8 of it
    **{f"{name}-{v}-header": f"under the terms of the GNU {title} as published by the Free Software Foundation; either version {v.removesuffix('.0')} of the License"
       for name, title, versions in (("GPL", "General Public License", ("2.0", "3.0")), ("LGPL", "Lesser General Public License", ("2.1", "3.0")),
                                     ("AGPL", "Affero General Public License", ("3.0",))) for v in versions},
    **{f"{name}-notice": f"This work is licensed under a Creative Commons {title} 4.0 International License."
       for name, title in (("CC-BY-4.0", "Attribution"), ("CC-BY-SA-4.0", "Attribution-ShareAlike"), ("CC-BY-ND-4.0", "Attribution-NoDerivatives"),
                           ("CC-BY-NC-4.0", "Attribution-NonCommercial"), ("CC-BY-NC-SA-4.0", "Attribution-NonCommercial-ShareAlike"),
                           ("CC-BY-NC-ND-4.0", "Attribution-NonCommercial-NoDerivatives"))},
    **{f"{name}-line": f"Licensed under {' '.join(name.replace('-', ' ', 1).rsplit('-', 1))}."
       for name in ("CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0")},
    # whole texts, as <id>-text
    **{f"{f.name.removesuffix('.txt')}-text": f.read_text("utf-8") for f in sorted(resources.files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name)
       if f.name.endswith(".txt")},
}


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+", -1), lambda w: w != "")


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """One hash per run of ``size`` words; fewer words are one run, none give an empty array."""

    def hashes(w: Column) -> Column:
        n = F.greatest(F.size(w) - size + 1, F.least(F.size(w), F.lit(1)))
        made = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
        return F.when(n > 0, made).otherwise(F.array().cast("array<long>"))

    return let(words, hashes)


def _class(n: int) -> int:
    size = 1
    while size < n:
        size *= 2
    return size


def _bands(hashes: Column) -> Column:
    """The smallest hash under each of the band's permutations, tagged with the band."""
    return F.array(*[F.xxhash64(F.lit(k), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k))))) for k in range(BANDS)])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, h, license, containment, first_word)``: templates of which a window holds at least 0.8 of the shingles.

    The templates are a fixed list, so their hashes are literals. A window that holds 0.8 of a template's shingles holds
    one of any fifth and one more of them, so windows are cut only around those, in the class of their template. ``h`` is the hash of the text; rows
    alike in id and text give one row a license. Null or empty texts, and empty templates, give none.
    """
    spark: SparkSession = docs.sparkSession
    rows = [(k, v) for k, v in (templates or TEMPLATES).items()]
    made = spark.createDataFrame(rows, "license string, t string").select("license", F.array_distinct(shingle_hashes(words_of(F.col("t")))).alias("s"))
    known = [(r["license"], sorted(r["s"])) for r in made.collect() if r["s"]]
    least = {}
    for _, s in known:
        least.setdefault(_class(len(s)), set()).update(s[:len(s) - math.ceil(CONTAINMENT * len(s) - 1e-9) + 1])
    classes = sorted(least)
    wanted = sorted(set().union(*least.values()))
    if not known:
        return spark.createDataFrame([], docs.select(F.col(doc_id).alias("doc_id")).schema.add("h", "long").add("license", "string")
                                     .add("containment", "double").add("first_word", "long"))
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    hits = lambda s: F.struct(s.alias("s"), F.filter(F.transform(s, lambda x, i: F.when(x.isin(wanted), i)), lambda i: i.isNotNull()).alias("at"))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("h"), let(shingle_hashes(words_of(t)), hits).alias("x"))
    base = checkpointed(base.where(F.size("x.at") > 0).select("doc_id", "h", "x.s", "x.at"))
    at = lambda c: F.filter("at", lambda i: F.get("s", i).isin(sorted(least[c])))
    windows = F.array_distinct(F.flatten(F.array(*[
        F.flatten(F.transform(at(c), lambda i: F.array(
            F.struct(F.lit(c).alias("c"), F.floor(i / c).cast("int").alias("k")),
            F.struct(F.lit(c).alias("c"), F.greatest(F.floor(i / c) - 1, F.lit(0)).cast("int").alias("k")))))
        for c in classes])))
    cut = base.select("doc_id", "h", "s", F.explode(windows).alias("w")).select(
        "doc_id", "h", F.col("w.c").alias("c"), F.col("w.k").alias("k"), F.array_distinct(F.slice("s", F.col("w.k") * F.col("w.c") + 1, 2 * F.col("w.c"))).alias("s"))
    cut = checkpointed(cut.distinct())
    lists = spark.createDataFrame([(lic, _class(len(s)), s) for lic, s in known], "license string, c int, ts array<long>")
    index = F.broadcast(lists.select("license", "c", "ts", F.explode(_bands(F.col("ts"))).alias("band")))
    found = cut.withColumn("band", F.explode(_bands(F.col("s")))).join(index, ["c", "band"])
    found = found.select("doc_id", "h", "license", "k", "c", (F.size(F.array_intersect("s", "ts")) / F.size("ts")).alias("containment"))
    best = found.where(F.col("containment") >= CONTAINMENT).groupBy("doc_id", "h", "license").agg(
        F.max(F.struct("containment", (-F.col("k").cast("long") * F.col("c")).alias("at"))).alias("m"))
    return best.select("doc_id", "h", "license", F.col("m.containment").alias("containment"), (-F.col("m.at")).alias("first_word"))
