"""Structured Streaming jobs over a file stream. Each runs to the end of the available
input, keeps its state in a checkpoint in the shared folder, and returns its result table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.monitoring import drift_status
from tallyframe.session import shared_path


def file_stream(spark: SparkSession, folder: str, table: str, bytes_per_batch: int = 64 << 30, files_per_batch: int | None = None) -> DataFrame:
    """The parquet files of one table as a stream; the schema comes from the files' footer.

    A table may be one file or a folder of part files. A batch takes files up to ``bytes_per_batch``, or a given
    number of them.
    """
    path = f"{folder.rstrip('/')}/{table}.parquet"
    batch = spark.read.parquet(path)
    source = spark.readStream.schema(batch.schema)
    source = source.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else source.option("maxBytesPerTrigger", bytes_per_batch)
    if is_folder(spark, path):
        return source.parquet(path)
    return source.option("pathGlobFilter", f"{table}.parquet").parquet(folder)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Asks the file system that the path names, so it also holds for stores only Spark can read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def run_to_end(stream: DataFrame, name: str, mode: str, transform=lambda d: d, at: str | None = None) -> DataFrame:
    """Run with ``availableNow``; complete-mode batches replace the table, append-mode batches are keyed by batch id,
    so a batch that runs again after a failure overwrites its own output.

    ``at`` is the folder of the state and the table: a later call with the same one goes on where the last ended.
    Without it each call starts anew in a fresh folder. No input gives an empty table.
    """
    spark = stream.sparkSession
    base = at.rstrip("/") if at else shared_path(spark, name)
    out = f"{base}/table"

    def write(batch: DataFrame, batch_id: int):
        target = out if mode == "complete" else f"{out}/batch={batch_id}"
        transform(batch).write.mode("overwrite").parquet(target)

    q = (stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state")
         .foreachBatch(write).trigger(availableNow=True).start())
    q.awaitTermination()
    if not is_folder(spark, out):
        return transform(spark.createDataFrame([], stream.schema))
    d = spark.read.parquet(out)
    return d.drop("batch") if mode != "complete" else d


def window_report(stream: DataFrame, time: str, value: str, key: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Count, sum and mean per tumbling window and key; rows later than the watermark are dropped."""
    s = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    g = s.groupBy(F.window(time, width), key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
    return g.select(F.col("window.start").alias("start"), key, "n", "total", "mean")


def reference_bins(ref: DataFrame, value: str, bins: int = 10) -> tuple[float, float, list[float]]:
    """Range and bin shares of the fixed reference: ``bins`` numbers, read once before the stream starts."""
    lo, hi = ref.agg(F.min(value), F.max(value)).first()
    g = ref.groupBy(bin_of(F.col(value), lo, hi, bins).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    n = sum(r["n"] for r in g)
    shares = [1e-6] * bins
    for r in g:
        shares[r["b"]] = r["n"] / n
    return float(lo), float(hi), shares


def bin_of(c, lo: float, hi: float, bins: int):
    """Equal-width bin of the reference range; values outside fall in the end bins."""
    return F.greatest(F.least(F.floor((c - lo) * bins / (hi - lo)), F.lit(bins - 1)), F.lit(0)).cast("int")


def drift_counts(stream: DataFrame, time: str, value: str, lo: float, hi: float, bins: int, width: str = "1 day",
                 late: str = "1 hour") -> DataFrame:
    s = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return s.groupBy(F.window(time, width), bin_of(F.col(value), lo, hi, bins).alias("b")).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("window.start").alias("start"), "b", "n")


def drift_report(counts: DataFrame, shares: list[float]) -> DataFrame:
    """PSI and status per window from its bin counts; bins without rows count with the floor share."""
    total = counts.groupBy("start").agg(F.sum("n").alias("t"), F.map_from_entries(F.collect_list(F.struct("b", "n"))).alias("m"))
    share = lambda i: F.coalesce(F.try_element_at("m", F.lit(i)) / F.col("t"), F.lit(1e-6))
    psi = sum((((share(i) - r) * F.log(share(i) / F.lit(r))) for i, r in enumerate(shares)), F.lit(0.0))
    return total.select("start", F.col("t").alias("n"), psi.alias("psi")).withColumn("status", drift_status(F.col("psi")))
