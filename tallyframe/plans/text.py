"""Text queries (classifiers are in ``models``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.functions.text import LETTERS, STOP_WORDS, tokens
from tallyframe.operators import text as TX
from tallyframe.plans.registry import query
from tallyframe.sources.tables import spread

STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
TOK = rf"""
tk AS (SELECT doc_id, lang, list_filter(string_split_regex(regexp_replace(lower(text), '[^{LETTERS}\s]', ' ', 'g'), '\s+'),
  lambda w: length(w) > 2 AND NOT list_contains([{STOP}], w)) AS ws FROM documents)
"""


@query("tokenize", f"""WITH {TOK} SELECT doc_id, CAST(len(ws) AS INT) AS n, md5(array_to_string(ws, ' ')) AS digest FROM tk""")
def tokenize(t):
    d = spread(t.documents).select("doc_id", tokens(F.col("text")).alias("ws"))
    return d.select("doc_id", F.size("ws").alias("n"), F.md5(F.array_join("ws", " ")).alias("digest"))


@query("bag_of_words", f"""WITH {TOK} SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS term FROM tk) GROUP BY 1, 2""")
def bag_of_words(t):
    return TX.bag_of_words(spread(t.documents), "doc_id", "text")


TFIDF = TOK + """,
wp AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM tk),
wn AS (SELECT doc_id, w, lead(w) OVER (PARTITION BY doc_id ORDER BY p) AS nx FROM wp),
gr AS (SELECT doc_id, w AS term FROM wn UNION ALL SELECT doc_id, w || ' ' || nx FROM wn WHERE nx IS NOT NULL),
tf AS (SELECT doc_id, term, count(*) AS tf FROM gr GROUP BY 1, 2),
vo AS (SELECT term, sum(tf) AS total, count(*) AS df FROM tf GROUP BY 1 ORDER BY total DESC, term LIMIT 100),
ww AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM tf JOIN vo USING (term)),
ti AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM ww)
"""


@query("tfidf", f"WITH {TFIDF} SELECT doc_id, term, round(weight, 6) AS weight FROM ti")
def tfidf(t):
    return TX.tfidf(spread(t.documents), "doc_id", "text", 100).withColumn("weight", F.round("weight", 6))


@query("top_terms_per_class", f"""
WITH {TFIDF}, s AS (SELECT lang, term, sum(weight) AS s FROM ti JOIN documents USING (doc_id) GROUP BY 1, 2),
n AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1),
r AS (SELECT lang, term, s / n AS m, row_number() OVER (PARTITION BY lang ORDER BY s / n DESC, term) AS rank FROM s JOIN n USING (lang))
SELECT lang, term, round(m, 6) AS mean_weight, CAST(rank AS INT) AS rank FROM r WHERE rank <= 5""")
def top_terms_per_class(t):
    w = TX.tfidf(spread(t.documents), "doc_id", "text", 100)
    return TX.top_terms_per_class(w, t.documents, "doc_id", "lang").withColumn("mean_weight", F.round("mean_weight", 6))


@query("cosine_similarity", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, vec_id, unnest(v) AS v, unnest(range(len(v))) AS p FROM e),
c AS (SELECT label, p, avg(v) AS m FROM x GROUP BY 1, 2),
own AS (SELECT x.vec_id, sum(v * m) / (sqrt(sum(v * v)) * sqrt(sum(m * m))) AS s FROM x JOIN c ON x.label = c.label AND x.p = c.p GROUP BY 1),
q AS (SELECT vec_id, v FROM e WHERE vec_id IN (0, 7, 42)),
sim AS (SELECT q.vec_id AS q, e.vec_id AS i, list_dot_product(q.v, e.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(e.v, e.v))) AS s FROM q JOIN e ON q.vec_id <> e.vec_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, i) AS rank FROM sim)
SELECT 'centroid' AS part, vec_id AS query, NULL::BIGINT AS item, round(s, 6) AS score FROM own
UNION ALL SELECT 'similar', q, i, round(s, 6) FROM rk WHERE rank <= 5""")
def cosine_similarity(t):
    e = t.embeddings
    own = e.join(TX.centroids(e, "embedding", "label"), "label").select(
        F.lit("centroid").alias("part"), F.col("vec_id").alias("query"), F.lit(None).cast("long").alias("item"),
        F.round(TX.cosine(F.col("embedding"), F.col("centroid")), 6).alias("score"))
    sim = TX.similar_items(e, "vec_id", "embedding", [0, 7, 42], 5).select(
        F.lit("similar").alias("part"), "query", "item", F.round("score", 6).alias("score"))
    return own.unionByName(sim)
