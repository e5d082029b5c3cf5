"""SimHash classes against brute force over all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyframe.llm import simhash
from tallyframe.llm.components import connected_components


def plain_simhash(t):
    w = (t or "").encode().lower().split()
    sh = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(fps, distance=4):
    up = list(range(len(fps)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (int(fps[i]) ^ int(fps[j])).bit_count() <= distance:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def near_classes(texts):
    """Brute force of the classes of ``keep_one``."""
    return classes([plain_simhash(t) for t in texts])


def test_fingerprint_and_classes(spark, odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    fps = [plain_simhash(r.text) for r in rows]
    assert [simhash.simhash(r.text or "") for r in rows] == fps
    root = classes(fps)
    ids = lambda k: [rows[i].doc_id for i in range(len(rows)) if root[i] == k and rows[i].doc_id is not None]
    want = sorted((str(rows[i].doc_id), fps[i], str(min(ids(root[i]), default=None))) for i in range(len(rows)))
    got = simhash.near_duplicate_classes(odd_docs).collect()
    assert sorted((str(r.doc_id), r.fp & (2 ** 64 - 1), str(r.component_id)) for r in got) == want


@pytest.mark.parametrize("bands,leaf,block", [(5, 16, 4096), (5, 16, 8), (3, 16, 4096), (1, 32, 4096)])
def test_links_lose_nothing(spark, bands, leaf, block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 64, 250, dtype=np.uint64)
    near = np.array([int(rng.choice(base)) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)) for _ in range(250)], np.uint64)
    dense = np.array([int(base[0]) ^ sum(1 << int(b) for b in rng.choice(12, rng.integers(0, 5), replace=False)) for _ in range(120)], np.uint64)
    fps = np.unique(np.concatenate([base, near, dense]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    links = simhash.fingerprint_links(df, bands=bands, leaf=leaf, block=block, sample=128)
    pairs = links.collect()
    assert all(((r.a ^ r.b) & (2 ** 64 - 1)).bit_count() <= 4 for r in pairs)
    label = {r.node: r.label for r in connected_components(links).collect()}
    root = classes(fps)
    got = {}
    for k, x in zip(root, fps.view(np.int64).tolist()):
        got.setdefault(k, set()).add(label.get(x, x))
    assert all(len(v) == 1 for v in got.values())
    assert len({min(v) for v in got.values()}) == len(got)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (5, None)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{k: 100 for k in range(100, 140)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one(spark, odd_docs, no_docs):
    assert simhash.keep_one(no_docs).count() == 0 and simhash.near_duplicate_classes(no_docs).count() == 0
    out = simhash.keep_one(odd_docs)
    assert out.schema.names == odd_docs.schema.names
    kept = sorted(str(r.doc_id) for r in out.collect())
    rows = odd_docs.select("doc_id", "text").collect()
    root = near_classes([r.text or "" for r in rows])
    want = [min((rows[i].doc_id for i in range(len(rows)) if root[i] == k and rows[i].doc_id is not None), default=None) for k in set(root)]
    assert kept == sorted(map(str, want))
