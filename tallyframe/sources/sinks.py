"""Writers. Each returns the frame read back from where it was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.sources.tables import read_csv


def write_csv(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return read_csv(df.sparkSession, path, df.schema)


def write_json_log(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def append_json_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a report and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_table(spark: SparkSession, path: str, schema: T.StructType, defaults: dict | None = None):
    """Declare an empty table at a path; returns ``insert(df)`` that fills defaults and appends.

    NOT NULL columns are enforced on insert: a null raises instead of being stored.
    """
    defaults = defaults or {}
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)

    def insert(df: DataFrame) -> DataFrame:
        out = []
        for f in schema.fields:
            c = F.col(f.name) if f.name in df.columns else F.lit(None)
            if f.name in defaults:
                c = F.coalesce(c, F.lit(defaults[f.name]))
            c = c.cast(f.dataType)
            if not f.nullable:
                c = F.coalesce(c, F.raise_error(F.lit(f"null in NOT NULL column {f.name}")).cast(f.dataType))
            out.append(c.alias(f.name))
        df.select(out).write.mode("append").parquet(path)
        return spark.read.schema(schema).parquet(path)

    return insert


def insert_rows(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """Append literal rows, cast to the table's schema."""
    return df.unionByName(df.sparkSession.createDataFrame(rows, df.schema))
