"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_of(name: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, also where lambdas inside the body use it."""
    return F.transform(F.array(value), body)[0]


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of all columns of a row; equal rows are equal in it."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def map_texts(df: DataFrame, fn: Callable[[list[str]], dict[str, pa.Array]], added: dict[str, T.DataType], text: str) -> DataFrame:
    """Adds columns computed from the texts of one Arrow batch at a time; all other columns pass through."""
    schema = T.StructType([*df.schema.fields, *[T.StructField(k, t) for k, t in added.items()]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = ["" if x is None else x for x in b.column(b.schema.get_field_index(text)).to_pylist()]
            out = fn(texts)
            cols, names = list(b.columns), list(b.schema.names)
            yield pa.RecordBatch.from_arrays([*cols, *out.values()], names=[*names, *out.keys()])

    return df.mapInArrow(run, schema)
