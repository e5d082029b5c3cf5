import pytest
from pyspark.sql import types as T

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew strong tea near quiet rivers under pale moons".split()
COLUMNS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    # names that operators also use for what they add
    T.StructField("fp", T.StringType()), T.StructField("toxicity", T.StringType()), T.StructField("h", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def prose(k: int, n: int) -> str:
    return " ".join(WORDS[(k * 7 + i * (k % 5 + 3) + i // 4) % len(WORDS)] + (str(k) if i % 6 == 0 else "") for i in range(n))


def odd_texts() -> list[str | None]:
    """Nulls, empties, very long, repeats, near copies, other scripts, astral characters, bare punctuation."""
    base = prose(1, 60)
    return [None, "", " ", "\n\t", "a", "one two three", base, base, base + " end", base.upper(), prose(2, 5000), prose(3, 90) + "\n" + prose(4, 40),
            "\U0001f600 " * 30, "日本語のテキスト", "ééé ñandú Σίσυφος", "... !!! ???", "zzzz" * 500, "x\x00y \x1c z", prose(5, 200), prose(5, 199) + " other"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    texts = odd_texts()
    rows = [(i, t, "s", "x", "y", None, None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, prose(6, 30), None, None, None, None, 1), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
