"""Readers for the tables a query works on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a data folder; files or a directory of part files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
