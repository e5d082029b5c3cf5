"""Packing: every id once, sequences gapless and within the capacity, little padding."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyframe.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_chunked_ids_equal_one_call(tokenizer):
    odd = ["", "ΣΑΣ, σας.", "It's they'LL 'twas don't.", "a\tb c\x1cd", "<|endoftext|> x<|startoftext|>y", "İstanbul K Å é́ ñ", "12a3!!?? ..",
           "ﬁne Ⅷ ¨", "!!!a...", "  \n\n x", "日本語。テスト", "é. Éa,", "'s.", "ſtop.", "ǅ ᾳ. Ω"]
    for t in odd:
        want = np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert next(iter(packing.token_bytes([t], PATH))) == want, t


def test_letters_are_asked_once_whatever_closes_them(tokenizer):
    """Only what closes the words reaches the full tokenizer; contractions, special tokens and other scripts keep their ids."""
    ids, asked = packing._Ids(PATH), []

    class Whole:
        def encode_batch_fast(self, texts, **kw):
            asked.extend(texts)
            return tokenizer.encode_batch_fast(texts, **kw)

    ids.whole = Whole()
    texts = ["Abc### abc*** (abc) abc) ABC% abc. zyx", "Straße]] été\" Ñu}.. abc`~", "", "abc"]
    odd = ["it's'' ab' we'LL, x<|endoftext|>## <|startoftext|>a.", "12a3)) a_b_ __ ΣΑΣ## é)) K@ ǅ/ \U0001f600## ·a ·", "x" * 300 + "$$$ \n\n a"]
    want = lambda ts: [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in ts]
    assert ids.encode(texts) == want(texts)
    assert set(asked) == {"", "###", "***", "(abc)", ")", "%", ".", "]]", '"', "}..", "`~"}
    assert ids.encode(odd) == want(odd) and ids.encode(texts[::-1]) == want(texts[::-1])
    ids.forget()
    ids.last[:] = False  # a vocabulary without marks of the end of words
    assert ids.encode(texts + odd) == want(texts + odd)


def check(rows, docs, tokenizer):
    left = {}
    for d, t in docs:
        left.setdefault(str(d), []).append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4"))
    covered = {}
    for r in rows:
        texts = {ids.tobytes(): ids for ids in left[str(r.doc_id)]}.values()
        fits = [ids for ids in texts if len(ids) == r.doc_tokens and zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32]
        assert fits and r.length > 0
        for i in range(r.start, r.start + r.length):
            covered[str(r.doc_id), i] = covered.get((str(r.doc_id), i), 0) + 1
    want = {}
    for d, texts in left.items():
        for ids in texts:
            for i in range(len(ids)):
                want[d, i] = want.get((d, i), 0) + 1
    assert covered == want
    seq = {}
    for r in rows:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 2048
    assert sorted(seq) == list(range(len(seq)))
    return 1 - sum(r.length for r in rows) / (2048 * len(seq))


def test_whole_table(spark, odd_docs, no_docs, tokenizer):
    assert packing.pack(no_docs, PATH).count() == 0
    check(packing.pack(odd_docs, PATH).collect(), [(r.doc_id, r.text) for r in odd_docs.collect()], tokenizer)


def test_many_equal_lengths_pack_tightly(spark, tokenizer):
    docs = [(i, " ".join(["word"] * (700 if i % 3 == 0 else 50 + i * 13 % 1900))) for i in range(900)]
    waste = check(packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect(), docs, tokenizer)
    assert waste < 0.015
    same = [(i, " ".join(["word"] * 1100)) for i in range(300)]
    assert check(packing.pack(spark.createDataFrame(same, "doc_id long, text string"), PATH).collect(), same, tokenizer) < 0.015


@pytest.mark.parametrize("words", [lambda i: 1 + i % 20, lambda i: 1 + i % 20 if i % 40 else 900 + i % 700, lambda i: 3, lambda i: 30 + i % 90])
def test_short_rows_pack_tightly(spark, tokenizer, words):
    docs = [(i, " ".join(["word"] * words(i))) for i in range(12000)]
    waste = check(packing.pack(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), PATH).collect(), docs, tokenizer)
    ideal = sum(len(tokenizer.encode(x, add_special_tokens=False).ids) + 1 for _, x in docs) / 2048
    assert ideal / (1 - waste) < 1.02 * ideal + 1  # the last sequence may be part full


def test_patterns_cover_and_come_near_the_bound():
    rng = np.random.default_rng(0)
    for n in (3, 200, 20_000):
        counts = dict(zip(*(x.tolist() for x in np.unique(rng.integers(1, 129, n), return_counts=True))))
        plan = packing.plan_patterns(counts, 128)
        slots = {}
        for pattern, times in plan:
            assert sum(s * k for s, k in pattern.items()) <= 128 and times > 0
            for s, k in pattern.items():
                slots[s] = slots.get(s, 0) + k * times
        assert all(slots[s] >= c for s, c in counts.items())
        used = sum(t for _, t in plan)
        bound = max(sum(s * c for s, c in counts.items()) / 128, sum(c for s, c in counts.items() if s > 64))
        assert used <= bound * 1.02 + 3
