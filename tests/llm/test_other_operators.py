"""Small tests of the other operators: brute force where there is one, and the odd rows all of them must take."""

import hashlib
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import chat, decontam, lcp, licenses, queries, sharding, toxicity, urlfilter

FOLDER = "/root/testdata/sf0.001"


# -- toxicity -------------------------------------------------------------------------------------

def plain_segments(w):
    """All maximal scoring segments by their definition: best subinterval first, then both sides."""
    best = max(((sum(w[i:j]), -(j - i), i, j) for i in range(len(w)) for j in range(i + 1, len(w) + 1)), default=(0,), key=lambda x: x[:2])
    if best[0] <= 0:
        return []
    s, _, i, j = best
    return plain_segments(w[:i]) + [(i, j, s)] + [(a + j, b + j, c) for a, b, c in plain_segments(w[j:])]


def test_segments_equal_the_definition():
    rng = random.Random(1)
    for _ in range(300):
        w = [rng.choice([-3.1, -1.7, -0.9, 1.3, 2.9, 4.7]) + rng.random() / 100 for _ in range(rng.randrange(0, 18))]
        got = toxicity.maximal_segments(np.array(w))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in plain_segments(w)]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        seq, toxic = [rng.choice(words) for _ in range(rng.randrange(5, 120))], i % 5 == 0
        if toxic:
            for _ in range(3):
                seq.insert(rng.randrange(len(seq)), rng.choice(["vile" + s for s in ("a", "lo", "x")] + ["nasty"]))
        docs.append((i, " ".join(seq)))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels + [(None, 1), (3, None), (10 ** 6, 1)], "doc_id long, toxic int"), dict(labels))


def test_held_out_accuracy_and_spans(labelled):
    docs, labels, truth = labelled
    held = F.col("doc_id") % 4 == 0
    model = toxicity.train(docs, labels, ~held)
    rows = toxicity.score_texts(docs, model).where(held).collect()
    assert np.mean([(r.toxicity >= 0.5) == bool(truth[r.doc_id]) for r in rows]) > 0.95
    for r in rows:
        for s in r.toxic_segments:
            assert "vile" in r.text[s.start:s.end] or "nasty" in r.text[s.start:s.end] or not truth[r.doc_id]


def test_odd_rows_and_no_labels(labelled, odd_docs, no_docs, spark):
    docs, labels, _ = labelled
    model = toxicity.train(docs, labels, F.lit(True))
    out = toxicity.keep_clean(odd_docs, model)
    assert out.schema.names == odd_docs.schema.names and out.count() == odd_docs.count()
    assert toxicity.keep_clean(no_docs, model).count() == 0
    none = toxicity.train(no_docs, labels.limit(0), F.lit(True))
    assert all(0 <= r.toxicity < 0.5 for r in toxicity.score_texts(odd_docs.drop("toxicity"), none).collect())


# -- chat -----------------------------------------------------------------------------------------

def test_chat_equals_plain_python(spark):
    rng = random.Random(3)
    logs = {}
    for c in range(120):
        base = logs[rng.randrange(c)] if c and rng.random() < 0.7 else []
        base = base[:rng.randrange(len(base) + 1)] if rng.random() < 0.3 else list(base)
        logs[c] = base + [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None, "yes\nno", "ok"])) for _ in range(rng.randrange(0, 4))]
    rows = [(c, i + (c % 3) * 2000, r, t, "x") for c, log in logs.items() for i, (r, t) in enumerate(log)]
    rows += [(999, i, "user", f"turn {i}", "x") for i in range(2500)] + [(None, 1, "user", "lost", "x"), (None, None, "user", "first", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string").repartition(5)
    got = {}
    for r in chat.render(df).collect():
        got.setdefault((r.conv_id, r.n_turns, r.copies), {})[r.part] = r.text
    logs = {k: tuple((r or "", t or "") for r, t in v) for k, v in logs.items() if v}
    logs[999], logs[None] = tuple(("user", f"turn {i}") for i in range(2500)), (("user", "first"), ("user", "lost"))
    want = {}
    for k, v in logs.items():
        if not any(len(o) > len(v) and o[:len(v)] == v for o in logs.values()):
            same = [c for c, o in logs.items() if o == v]
            if k == min(same, key=lambda c: (c is None, c)):
                want[k, len(v), len(same)] = "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in v)
    assert {k: "".join(v[i] for i in sorted(v)) for k, v in got.items()} == want
    assert chat.render(df.limit(0)).count() == 0


# -- decontamination ------------------------------------------------------------------------------

def test_decontamination(spark, odd_docs, no_docs):
    rng = random.Random(4)
    vocab = [f"{a}{b}" for a in ("ka", "lo", "mi", "re") for b in range(60)]
    sentence = lambda n: " ".join(rng.choice(vocab) for _ in range(n)).capitalize() + "."
    items = [(i, sentence(rng.randrange(8, 40)) + " " + sentence(6)) for i in range(50)] + [(90, ""), (91, None), (7, "Short one here.")]
    docs, want = [], set()
    for d in range(200):
        t = sentence(rng.randrange(1, 300))
        if d % 4 == 0:
            i, text = items[d % 50]
            t = t + "\n" + (text.upper() if d % 8 else text.replace(" ", "  ")) + "\n" + sentence(40)
            want.add((d, i))
        docs.append((d, t))
    df = spark.createDataFrame(docs + [(500, None)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(df, bench).collect()}
    assert got == want
    kept = decontam.keep_uncontaminated(df, bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want} | {500}
    clean = decontam.keep_uncontaminated(odd_docs, bench)
    assert clean.count() == odd_docs.count() and clean.schema == odd_docs.schema
    assert decontam.contaminated(no_docs, bench).count() == 0 and decontam.contaminated(df, bench.limit(0)).count() == 0


def test_retrieval_equals_full_scoring():
    rng = random.Random(5)
    vocab = [f"t{i}" for i in range(80)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(6, 30)))) for i in range(70)]
    df = {}
    for _, t in items:
        for w in set(t.split()):
            df[w] = df.get(w, 0) + 1
    ix = decontam.build_index(items, df, len(items), 18.0)
    for _ in range(200):
        terms = np.array(sorted({ix.terms[w] for w in (rng.choice(vocab) for _ in range(30)) if w in ix.terms}))
        full = {}
        for block in ix.postings:
            for t in terms.tolist():
                for i, v in zip(*block.get(t, ((), ()))):
                    full[int(i)] = full.get(int(i), 0.0) + float(v)
        got = decontam.retrieve(ix, terms, 0.4)
        assert set(got) == {i for i, v in full.items() if v >= 0.4 - 1e-9}


# -- licenses -------------------------------------------------------------------------------------

def test_licenses(spark, odd_docs, no_docs):
    t = licenses.TEMPLATES
    filler = " ".join(f"x{i}" for i in range(300))
    cut = " ".join(t["MIT-grant"].split()[:-2])
    docs = [(1, f"{filler} {t['Apache-2.0'].upper()} {filler}"), (2, t["MIT"]), (3, f"{filler}\n{cut}"), (4, "Licensed under the moon."), (5, None),
            (6, f"{t['GPL-3.0']} {t['MIT']}"), (6, f"{t['GPL-3.0']} {t['MIT']}")]
    got = sorted((r.doc_id, r.license) for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == [(1, "Apache-2.0"), (2, "MIT"), (3, "MIT-grant"), (6, "GPL-3.0"), (6, "MIT")]
    assert licenses.scan(no_docs).count() == 0 and licenses.scan(odd_docs).count() == 0


def test_licenses_that_the_tables_do_not_hold(spark):
    """Whole texts, bodies without their first sentence, standard headers and other Creative Commons lines."""
    folder = Path(licenses.__file__).parent / "license_texts"
    body = lambda name: (folder / f"{name}.txt").read_text()
    filler = " ".join(f"x{i}" for i in range(500))
    names = ["ISC", "Zlib", "BSD-3-Clause", "LGPL-2.1", "GPL-3.0", "Apache-2.0", "MPL-2.0"]
    docs = [f"{filler}\n{body(n).upper()}\n{filler}" for n in names]
    later = [("MIT-text", body("MIT").split("restriction, ")[1]), ("BSD-2-Clause-text", body("BSD-2-Clause").split("are met:")[1]),
             ("AGPL-3.0-header", "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU Affero General Public "
              "License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version."),
             ("Apache-2.0-header", licenses.TEMPLATES["Apache-2.0-header"].replace("You may", "// You may")),
             ("CC-BY-SA-4.0-line", f"{filler} Licensed under CC BY-SA 4.0. {filler}"),
             ("CC-BY-4.0-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License")]
    docs += [t for _, t in later]
    want = [f"{n}-text" for n in names] + [n for n, _ in later]
    found = {}
    for r in licenses.scan(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4)).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    assert [i for i, n in enumerate(want) if n not in found.get(i, ())] == []
    assert all(found[i] == {n} for i, n in enumerate(want) if not n.endswith("-text"))


# -- sharding -------------------------------------------------------------------------------------

def test_sharding(spark, odd_docs, no_docs):
    rows = [(i, "same text that fills a third" if i % 3 == 0 else "t" * (i * 37 % 900) + str(i)) for i in range(6000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 16).collect()
    size, slots = [0] * 16, {}
    for r in out:
        assert r["__size"] == len(r.text.encode()) + 1
        size[r["__shard"]] += r["__size"]
        slots.setdefault(r["__shard"], []).append(r["__slot"])
    assert len(out) == 6000 and max(size) - min(size) < 0.01 * sum(size) / 16 + 2 * 1000
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    odd = sharding.shard(odd_docs)
    assert odd.count() == odd_docs.count() and sharding.shard(no_docs).count() == 0


# -- fingerprints ---------------------------------------------------------------------------------

def test_fingerprints_follow_the_text_alone():
    rng = random.Random(6)
    text = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    texts = ["", "a", "ab", "zz" * 400, text(5), text(300), text(900), "日本語" * 50]
    alone = [lcp.fingerprints([t])[0] for t in texts]
    together = lcp.fingerprints(texts + texts[::-1])
    for k, f in enumerate(alone):
        assert np.array_equal(f, together[k]) and np.array_equal(f, together[-1 - k])
    body = text(600)
    shifted = lcp.fingerprints([body, "intro of any length " + body, text(600)])
    assert lcp.likeness(shifted[0], shifted[1]) > 0.8 > 0.2 > lcp.likeness(shifted[0], shifted[2])
    assert lcp.likeness(alone[0], alone[0]) == 1.0 and lcp.likeness(alone[0], alone[5]) == 0.0


def plain_level(syms):
    """One level of the parse of one text, symbol by symbol: runs, three coin tosses, phrases at local maxima, names."""
    mix, mask = lcp._mix, (1 << 64) - 1
    hashed = lambda x: int(mix(np.array([x & mask], np.uint64))[0])
    runs = []
    for x in syms:
        if runs and runs[-1][0] == x:
            runs[-1][1] += 1
        else:
            runs.append([x, 1])
    syms = [x if n == 1 else hashed(x + n * int(lcp._A)) for x, n in runs]
    coins = syms
    for _ in range(3):
        tossed = []
        for i, x in enumerate(coins):
            diff = 1 if i == 0 else x ^ coins[i - 1]
            k = (diff & -diff).bit_length() - 1 if diff else (64 if coins is syms else 8)
            tossed.append(2 * k + (x >> k & 1))
        coins = tossed
    begin = [i for i, c in enumerate(coins) if i == 0 or (i + 1 < len(coins) and coins[i - 1] < c > coins[i + 1])]
    out = []
    for a, b in zip(begin, [*begin[1:], len(syms)]):
        out.append(hashed(sum(hashed(x + int(lcp._A)) * pow(int(lcp._C), k + 1, 1 << 64) for k, x in enumerate(syms[a:b]))))
    return out


def plain_fingerprint(text):
    syms, names = [ord(c) for c in text], set()
    for level in (1, 2, 3):
        syms = plain_level(syms) if syms else []
        names |= {x >> 32 for x in syms} if level > 1 else set()
    names = sorted(names)
    return [x for k, x in enumerate(names) if k < lcp.KEPT or x < lcp.BOUND], names


def test_fingerprints_equal_a_plain_parse():
    rng = random.Random(12)
    words = ["alpha", "beta", "gamma", "delta", "eps", "ééé", "日本", "\U0001f600"]
    texts = ["", "a", "aaaa", "aab" * 9, *[" ".join(rng.choices(words, k=rng.randrange(1, 120))) for _ in range(25)],
             " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(2500))]
    with np.errstate(over="ignore"):
        want = [plain_fingerprint(t) for t in texts]
    got = lcp.fingerprints(texts)
    assert [g.tolist() for g in got] == [w for w, _ in want]
    assert len(got[-1]) > 2 * lcp.KEPT  # long texts keep more
    for i in range(4, len(texts)):  # the likeness is that of all names, or near it
        a, b = set(want[i - 1][1]), set(want[i][1])
        exact = len(a & b) / len(a | b)
        assert abs(lcp.likeness(got[i - 1], got[i]) - exact) <= (0 if max(len(a), len(b)) < lcp.KEPT else 0.2)


def test_likeness_of_long_texts():
    """Over long texts the estimate stays near the likeness of all names."""
    rng = random.Random(13)
    words = [f"{rng.randrange(10 ** 5)}" for _ in range(3000)]
    errors = []
    for share in (0.1, 0.3, 0.5, 0.7, 0.9):
        texts = [" ".join(words), " ".join(words[:int(share * 3000)] + [f"x{rng.randrange(10 ** 5)}" for _ in range(1500)])]
        with np.errstate(over="ignore"):
            a, b = (set(plain_fingerprint(t)[1]) for t in texts)
        errors.append(abs(lcp.likeness(*lcp.fingerprints(texts)) - len(a & b) / len(a | b)))
    assert np.mean(errors) < 0.03 and max(errors) < 0.06, errors


def test_next_document(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text or "") for r in odd_docs.collect() if r.doc_id is not None]
    rows = list(dict(rows).items())
    order = sorted(rows, reverse=True)
    want = {}
    for k, (d, t) in enumerate(order):
        m = len(t) // 3
        want[d] = t[:len(t) - m] + order[(k + 1) % len(order)][1][:m]
    for buckets in (1, 7):
        got = lcp.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string"), buckets=buckets).collect()
        assert {r.doc_id: r.edited for r in got} == want and len(got) == len(want)
    assert lcp.fingerprint_documents(odd_docs).count() == odd_docs.count()
    assert lcp.fingerprint_documents(no_docs).count() == 0
    one = lcp.fingerprint_documents(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert one.edited == "abcdab" and one.near_next == 1.0


# -- url filters ----------------------------------------------------------------------------------

def test_cascade_is_exact_on_its_universe(spark):
    rng = np.random.default_rng(7)
    h = rng.integers(-2 ** 63, 2 ** 63 - 1, (20_000, 2))
    rows = [(int(a), int(b), i % 9 == 0) for i, (a, b) in enumerate(h)]
    cascade = urlfilter.build(spark.createDataFrame(rows, "h1 long, h2 long, listed boolean"))
    assert len(cascade.levels) > 1
    got = cascade.contains(h[:, 0].astype(np.int64).view(np.uint64), h[:, 1].copy().view(np.uint64))
    assert got.tolist() == [x for *_, x in rows]


def test_large_universe_is_split(spark, monkeypatch):
    """A short list over a large universe takes several cascades as well, and deeper ones; answers stay exact."""
    built = []
    build = urlfilter.build
    monkeypatch.setattr(urlfilter, "build", lambda u: built.append(build(u)) or built[-1])
    rows = spark.range(60_000).select(F.array(F.struct(*[h.alias(n) for h, n in zip(urlfilter.key_hash(F.col("id").cast("string")), ("h1", "h2"))])).alias("k"), "id")
    listed = spark.range(0, 60_000, 300).select(F.col("id").cast("string").alias("key"))
    got = urlfilter.flag(rows, listed, "k", "hit", per_cascade=150).select("id", F.col("hit")[0].alias("hit")).collect()
    assert len(built) == 2 and max(len(c.levels) for c in built) >= 2
    assert len(got) == 60_000 and all(r.hit == (r.id % 300 == 0) for r in got)


@pytest.mark.parametrize("per", [4_000_000, 3])
def test_urls(spark, monkeypatch, per):
    monkeypatch.setattr(urlfilter.flag, "__defaults__", ("key", per))
    urls = [None, "", "no scheme", "http://", "https://A.Example.ORG/es/1?q#f", "ftp://example.org", "http://notexample.org/es/x", "x://example.org/en/17",
            "http://example.com/fr/1", "http://bad.net/a", "http://sub.bad.net?x", "http://a.b.com/de/", "http://example.org/en/2://y"]
    pages = spark.createDataFrame([(i, u, "z") for i, u in enumerate(urls)] + [(3, "http://", "z")], "page_id long, url string, host string")
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
             (None, "/", "block")]
    got = urlfilter.judge(pages, spark.createDataFrame(rules, "host string, path string, action string"), spark.createDataFrame([("bad.net",), (None,)], "host string")).collect()
    assert len(got) == len(urls) + 1
    said = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert said[4] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert said[5] == ("example.org", "", None, "allow") and said[6][2:] == ("org/", "allow") and said[7][2:] == ("example.org/en/1", "block")
    assert said[8][2:] == ("com/fr/", "allow") and said[9][2:] == (None, "block") and said[10] == ("sub.bad.net", "", None, "block")
    assert said[11][2:] == ("com/de/", "block") and said[12][:3] == ("example.org", "/en/2://y", "org/")
    assert all(said[i] == ("", "", None, "allow") for i in range(4))


# -- registered queries and the pipeline ----------------------------------------------------------

def test_queries_with_sql(spark):
    import __spark_entry__ as entry
    from tools.compare import compare, connect

    con = connect(FOLDER)
    for name in ("op2_chat_formatting", "op10_url_filter"):
        df = entry.queries()[name](spark, FOLDER)
        cur = con.execute(entry.oracle_sql()[name])
        assert compare(df.dtypes, [tuple(r) for r in df.collect()], [(d[0], str(d[1])) for d in cur.description], cur.fetchall()) == ""


def test_pipeline_stages(spark, tmp_path, odd_docs, no_docs):
    import corpus_pipeline as P
    from tests.llm.test_simhash import near_classes

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert out.columns == docs.columns
            before, after = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in out.collect()}
            assert len(after) == out.count() and set(after) <= set(before)
            if name == "near_dedup":
                ids = sorted(before)
                root = near_classes([before[i] or "" for i in ids])
                assert set(after) == {ids[r] for r in set(root)}
            if name == "decontamination":
                plain = lambda t: " ".join(t.lower().split())
                items = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
                assert set(before) - set(after) >= {i for i, t in before.items() if any(q in plain(t) for q in items)}
            if name == "secrets":
                assert set(after) == set(before)
        docs = out
    assert {r.doc_id for r in docs.collect()} == set(after)


def test_pipeline_on_odd_and_empty_tables(spark, tmp_path, odd_docs, no_docs):
    """Odd rows pass all stages: one of the texts without words and one of each group of copies stays; empty stays empty."""
    import corpus_pipeline as P
    from tests.llm.test_simhash import near_classes

    for docs, empty in ((odd_docs, False), (no_docs, True)):
        for k, (name, stage) in enumerate(P.STAGES):
            out = stage(spark, docs, FOLDER)
            assert name == "packing" or out.columns == docs.columns
            before = docs.collect()
            at = f"{tmp_path}/{empty}{k}"
            out.write.parquet(at)
            docs = spark.read.schema(out.schema).parquet(at)
            if name == "near_dedup":
                assert docs.count() == len(set(near_classes([r.text or "" for r in before])))
            if name == "secrets":
                assert docs.count() == len(before)
        assert (docs.count() == 0) == empty


def test_text_hash_is_that_of_the_edited_text(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["op9_document_fingerprints"](spark, FOLDER).collect()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    order = sorted(text, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    for r in rows:
        t, m = text[r.doc_id], len(text[r.doc_id]) // 3
        assert r.edited_sha256 == hashlib.sha256((t[:len(t) - m] + text[after[r.doc_id]][:m]).encode()).hexdigest()


def test_logistic_fit_settles_on_separable_rows():
    rng = np.random.default_rng(8)
    for n in (40, 4000):
        y = (rng.random(n) < 0.12).astype(float)
        x = np.column_stack([y * rng.uniform(2, 50, n), y * rng.uniform(1, 5, n)])
        b0, b1, b2 = toxicity._logistic(x, y)
        assert (((b0 + b1 * x[:, 0] + b2 * x[:, 1]) >= 0) == (y == 1)).mean() > 0.99


def test_weights_stay_finite_for_very_frequent_words():
    keys = np.sort(toxicity._features(["abcdefghijkl"])[0][0])
    big, zero, prior = (np.full(len(keys), x, np.float32) for x in (1e7, 0, 3))
    for toxic, clean, sign in ((big, zero, 1), (zero, big, -1)):
        w = toxicity.Model(keys, toxic, clean, prior, 2e6, 2e7).weight("Abcdefghijkl!")
        assert np.isfinite(w) and w * sign > 0


def plain_names(text):
    """Features of a text with their counts: every word's prefixes of 4, 5 and 6 letters, and the word itself."""
    words = [w.lower().strip(".,!?") for w in (text or "").split()]
    return Counter(x for w in words if w for x in [*[(k, w[:k]) for k in (4, 5, 6) if len(w) > k], (0, w)])


def test_every_feature_is_counted_by_itself(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CACHE", 40)  # counts are handed over many times
    rng = random.Random(9)
    words = [a + b for a in ("alpha", "beta", "gammas", "de") for b in ("", "x", "yz", "one", "two.", "É")]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 30))) or None) for i in range(150)] + [(3, "alpha repeated"), (None, "alphayz lost")]
    labels = {i: i % 3 == 0 for i in range(90)}
    model = toxicity.train(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                           spark.createDataFrame([(i, int(y)) for i, y in labels.items()], "doc_id long, toxic int"), F.lit(True))
    fit = {r[0] for r in toxicity.labelled_rows(spark.createDataFrame([(i, int(y)) for i, y in labels.items()], "doc_id long, toxic int"), F.lit(True), 1000)
           .where("__fit").collect()}
    toxic, clean, every = Counter(), Counter(), Counter()
    for i, t in docs:
        names = plain_names(t)
        every += names
        if i in fit:
            (toxic if labels[i] else clean).update(names)
    seen = sorted(set(toxic) | set(clean))
    assert len(model.keys) == len(seen) and (model.n_toxic, model.n_clean) == (sum(toxic.values()), sum(clean.values()))
    # a word's own name is in the last column, a prefix's in the column of its length, whatever follows it
    names = np.array([toxicity._features([w if not k else w + "rest"])[0][0, (4, 5, 6, 0).index(k)] for k, w in seen])
    assert len(set(names.tolist())) == len(seen) and not toxicity._features(["", "abc"])[1][0].any()
    t, c, p = model.evidence(names)
    assert t.tolist() == [toxic[x] for x in seen] and c.tolist() == [clean[x] for x in seen]
    assert np.allclose(p, [toxicity.PRIOR + toxicity.BACKGROUND * every[x] / sum(every.values()) for x in seen])


def test_held_out_labels_are_never_used(spark):
    """The query's scores stay the same when every held-out label is flipped."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(queries.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.train(docs, x, ~queries.held_out()) for x in (labels, flipped))
    assert a.curve == b.curve and (a.lam, a.k) == (b.lam, b.k)
    for x, y in ((a.keys, b.keys), (a.toxic, b.toxic), (a.clean, b.clean), (a.prior, b.prior)):
        assert np.array_equal(x, y)
    out = queries.QUERIES["op1_toxicity"](spark, FOLDER).collect()
    assert len(out) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in out)
