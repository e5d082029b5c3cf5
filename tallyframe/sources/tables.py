"""Reading the supplied tables, and typed readers for text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Attribute access to the parquet tables of one folder: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._schemas: dict[str, T.StructType] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        path = f"{self.folder}/{name}.parquet"
        if name not in self._schemas:  # footers are read once per table, not once per use
            self._schemas[name] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[name]).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Spread a fresh scan over the cluster before heavy work per row, such as splitting long texts.

    Only a scan with fewer partitions than the cluster has cores is
    repartitioned, so a large table, which has more, is never shuffled here.
    """
    want = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(want) if scan.rdd.getNumPartitions() < want else scan


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema (no inference pass over the data)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def parse_dates(df: DataFrame, *columns: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """ISO date text to timestamps while reading."""
    return df.withColumns({c: F.to_timestamp(c, fmt) for c in columns})
