"""Session construction and the few settings the operators read from it."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "tallyframe") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    parts = str(cores) if str(cores).isdigit() else str(os.cpu_count() or 8)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", parts)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shuffle_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; a temporary one only in local mode, where all tasks see it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tallyframe-ckpt-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    The table survives the loss of executors and cuts the lineage. Unlike
    ``DataFrame.checkpoint`` it also drops the constraints Spark derives from
    the plan so far; those grow from round to round in a loop.
    """
    path = shared_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, for tables a job writes and reads back."""
    set_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def bucketed(df: DataFrame, *keys: str) -> Iterator[DataFrame]:
    """The frame as a written table bucketed and sorted by ``keys``, for loops that join the same rows in every round.

    Joins on the keys then read it in place and shuffle only the other side. Inside the block the table has a name in the
    session's catalog; results that outlive the block must be written before it ends.
    """
    spark = df.sparkSession
    name, n = f"bucketed_{uuid.uuid4().hex}", shuffle_parallelism(spark)
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", shared_path(spark, "bucketed")).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
