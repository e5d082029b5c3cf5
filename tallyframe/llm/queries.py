"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyframe.llm import (chat, decontam, lcp, licenses, mainblocks, negatives, packing, secrets, sharding, simhash, spelling, toxicity,
                           urlfilter)
from tallyframe.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


def held_out():
    """The ids that nothing is learned from, null among them; a function, as columns need a session."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


@query("op1_toxicity")
def _(t):
    """Score of every document by its toxic segments, learned from the labels of four fifths of the ids."""
    model = toxicity.train(t.documents, t.labels, ~held_out())
    out = toxicity.score_texts(t.documents.select("doc_id", "text"), model)
    return out.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"),
                      (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
                      F.array_join(F.transform("toxic_segments", lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias("segments"))


CHAT_SQL = """
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations),
c as (select conv_id, count(*) as n, list(role || chr(0) || text order by pos) as k from t group by conv_id),
g as (select k, n, min(conv_id) as conv_id, count(*) as copies from c group by k, n),
m as (select * from g where not exists (select 1 from g h where h.n > g.n and h.k[1:g.n] = g.k))
select t.conv_id, cast((t.pos - 1) // 64 as bigint) as part, m.n as n_turns, m.copies,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by pos) as text
from t join m on t.conv_id is not distinct from m.conv_id group by 1, 2, 3, 4
"""


@query("op2_chat_formatting", CHAT_SQL)
def _(t):
    """Maximal conversations in chat markup."""
    return chat.render(t.conversations)


@query("op3_secret_scan")
def _(t):
    """Secrets of every document: base spans and linked parts."""
    return secrets.report(secrets.scan(t.documents))


@query("op4_benchmark_decontamination")
def _(t):
    """Every document and test item it contains."""
    return decontam.contaminated(t.documents, t.benchmark).drop("h")


@query("op5_packing")
def _(t):
    """All documents' ids in sequences of 2048."""
    import public_tokenizers

    out = packing.pack(t.documents, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op6_license_scan")
def _(t):
    """Licenses named in every document."""
    return licenses.scan(t.documents).drop("h")


@query("op7_simhash_near_dedup")
def _(t):
    """Class of every document under fingerprints at most four bits apart."""
    out = simhash.near_duplicate_classes(t.documents)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op8_sharding")
def _(t):
    """Shard and slot of every document, balanced by bytes."""
    out = sharding.shard(t.documents.select("doc_id", "text"))
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return out.select("doc_id", F.col("__size").alias("size"), crc.alias("text_crc32"), F.lit("bytes").alias("law"), F.col("__shard").alias("shard"),
                      F.col("__slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query("op9_document_fingerprints")
def _(t):
    """Fingerprints of every text and its edited form, and their likeness."""
    out = lcp.fingerprint_documents(t.documents)
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
                      "near_edited", "near_next")


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Words that put a host of the corpus on the list when they stand alone between dots and hyphens.
LISTED_WORDS = "casino|pills|spam|malware|phish|porn|warez|xxx"
URL_SQL = f"""
with p as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages),
r(h, f, action) as (values {", ".join(map(str, RULES))}),
m as (select *, (select h || f || chr(0) || action from r where (host = h or ends_with(host, '.' || h)) and starts_with(path, f)
                 order by length(h || f) desc, length(h) desc limit 1) as best from p),
s as (select distinct host from p where regexp_matches(host, '(^|[.-])({LISTED_WORDS})([.-]|$)'))
select page_id, host, path, split_part(best, chr(0), 1) as rule,
       case when best is not null then split_part(best, chr(0), 2)
            when exists (select 1 from s where m.host = s.host or ends_with(m.host, '.' || s.host)) then 'block' else 'allow' end as verdict
from m
"""


@query("op10_url_filter", URL_SQL)
def _(t):
    """Verdict on every page: the longest rule's, else the host list's."""
    rules = t.spark.createDataFrame(RULES, "host string, path string, action string")
    hosts = t.pages.select(urlfilter.host_of(F.col("url")).alias("host")).distinct()
    return urlfilter.judge(t.pages, rules, hosts.where(F.col("host").rlike(f"(^|[.-])({LISTED_WORDS})([.-]|$)")))


@query("op11_html_extraction")
def _(t):
    """Main text of every page."""
    out = mainblocks.extract(t.pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


SPELLING_SQL = """
with recursive d as (
  select coalesce(cast(doc_id as varchar), '') as id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]{7,}')) as run
  from documents),
g as (select id, run, id || ':' || run as s, count(*) as c from d group by all),
b as (select run, c, flatten(list_transform(range(1, length(s) + 1), lambda i: case when unicode(s[i]) < 128 then [cast(unicode(s[i]) as bigint)]
                     else [192 + (cast(unicode(s[i]) as bigint) >> 6), 128 + (cast(unicode(s[i]) as bigint) & 63)] end)) as bytes from g),
h as (select run, c, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda x, y:
               list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda u, v: case when u & 1 = 1 then xor(u >> 1, 3988292384) else u >> 1 end))) as h from b),
w as (select word, cast(sum(c) as bigint) as n from (
        select case when h % 31 = 0 then left(run, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) + 2 as bigint)) else run end as word, c from h)
      where length(word) >= 7 group by word having sum(c) >= 2),
i as (select word, n, unnest(range(1, length(word) + 2)) as i from w),
p as (select word, n, left(word, i - 1) || '.' || substr(word, i + 1) as k from i where i <= length(word)
      union all select word, n, left(word, i - 1) || '.' || substr(word, i) from i),
e as (select distinct a.word, a.n, b.word as near, b.n as near_n from p a join p b using (k) where a.word <> b.word),
m as (select word, n, count(*) as n_near, first(near order by near_n desc, near) as form, max(near_n) as form_n from e group by word, n),
f as (select word, form, form_n from m where form_n >= 10 * n),
r as (select word, form as root from f union all select r.word, f.form from r join f on r.root = f.word),
z as (select word, root from r where root not in (select word from f))
select w.word, f.form, coalesce(z.root, w.word) as root, w.n, coalesce(m.n_near, 0) as n_near, f.form_n
from w left join m using (word) left join f using (word) left join z using (word)
"""


@query("op12_spelling_variants", SPELLING_SQL)
def _(t):
    """Words of all documents with their near words and the form they vary."""
    return spelling.variants(t.documents)


NEGATIVES_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as x
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, cast(list_inner_product(a.x, b.x) as bigint) as score
      from v a, v b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from (
  select anchor_id, positive_id, s.vec_id as negative_id, positive_score, score as negative_score,
         cast(row_number() over (partition by anchor_id, positive_id order by score desc, s.vec_id) as integer) as rank
  from p join s using (anchor_id)
  where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
where rank <= 10
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def _(t):
    """Hard negatives of every anchor and positive."""
    return negatives.hard_negatives(t.embeddings)
