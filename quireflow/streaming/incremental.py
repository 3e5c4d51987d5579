"""Streams of records: first arrivals, windows with late rows, and state kept by digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.state import upsert


def first_arrivals(stream: DataFrame, key: str, time: str, late: str = "30 days") -> DataFrame:
    """Each key once, within the time that rows may be late; the state is bounded by that time."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, by: list[str], width: str, late: str = "30 days") -> DataFrame:
    """Counts by window and columns; a window is final when rows of it can no longer arrive."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def keep_latest(path: str, keys: list[str], version: str):
    """A function for ``foreachBatch``: merges each batch into the table at ``path`` by key and version.

    A batch that is run again gives the same table; versions are written side by side, and
    one counts when its ``_SUCCESS`` file stands, so a reader always finds a whole table.
    Each batch writes the whole table anew, so this is for tables that are small beside the stream.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        jvm = spark.sparkContext._jvm
        fs_path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        done = sorted(int(s.getPath().getName()[1:]) for s in (fs.listStatus(fs_path(path)) if fs.exists(fs_path(path)) else []) if s.getPath().getName().startswith("v") and fs.exists(fs_path(f"{path}/{s.getPath().getName()}/_SUCCESS")))
        earlier = [v for v in done if v < batch_id]
        new = batch.select(*batch.columns)
        merged = upsert(spark.read.parquet(f"{path}/v{earlier[-1]}"), new, keys, version) if earlier else upsert(new.limit(0), new, keys, version)
        merged.write.mode("overwrite").parquet(f"{path}/v{batch_id}")
        for v in earlier[:-1]:
            fs.delete(fs_path(f"{path}/v{v}"), True)

    return merge


def latest_version(spark, path: str) -> DataFrame:
    """The table that ``keep_latest`` wrote last."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [int(s.getPath().getName()[1:]) for s in fs.listStatus(root) if s.getPath().getName().startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{s.getPath().getName()}/_SUCCESS"))]
    return spark.read.parquet(f"{path}/v{max(done)}")
