"""Checks that return their findings as rows (``kind``, ``key``, ``detail``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finding(df: DataFrame, kind: str, key: Column | str, detail: Column | None = None) -> DataFrame:
    key = F.col(key) if isinstance(key, str) else key
    return df.select(F.lit(kind).alias("kind"), key.cast("string").alias("key"), (F.lit(None) if detail is None else detail).cast("string").alias("detail"))


def report(*findings: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, findings)


def missing_references(df: DataFrame, column: str, to: DataFrame, to_column: str, kind: str) -> DataFrame:
    """Distinct values that are no key of the other table; nulls refer to nothing and are no finding."""
    return finding(df.select(column).dropna().distinct().join(to.select(F.col(to_column).alias(column)).distinct(), column, "left_anti"), kind, column)


def repeated_keys(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    n = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return finding(n, kind, F.concat_ws("/", *[F.col(c).cast("string") for c in columns]), F.col("_n"))


def count_differences(expected: DataFrame, actual: DataFrame, keys: list[str], column: str, kind: str) -> DataFrame:
    """Keys whose counts differ; a key that one side lacks counts 0 there."""
    both = expected.select(*keys, F.col(column).alias("_e")).join(actual.select(*keys, F.col(column).alias("_a")), keys, "full_outer").na.fill(0, ["_e", "_a"]).filter("_e != _a")
    return finding(both, kind, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), F.concat_ws(" != ", "_e", "_a"))


def set_differences(left: DataFrame, right: DataFrame, column: str, kinds: tuple[str, str]) -> DataFrame:
    """Values that only one of two tables has."""
    a, b = left.select(column).dropna().distinct(), right.select(column).dropna().distinct()
    return finding(a.join(b, column, "left_anti"), kinds[0], column).union(finding(b.join(a, column, "left_anti"), kinds[1], column))


def multiset_differences(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """(column, left_count, right_count) of the values that stand unequally often on the two sides."""
    a = left.groupBy(column).agg(F.count(F.lit(1)).alias("left_count"))
    b = right.groupBy(column).agg(F.count(F.lit(1)).alias("right_count"))
    return a.join(b, column, "full_outer").na.fill(0, ["left_count", "right_count"]).filter("left_count != right_count")


def out_of_range(df: DataFrame, key: str, column: str, low: float, high: float, kind: str) -> DataFrame:
    """Values outside [low, high], and nulls."""
    return finding(df.filter(~F.coalesce(F.col(column).between(low, high), F.lit(False))), kind, key, F.col(column))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, rows, nulls, empties, distinct_values) of each column, in one pass over the table."""
    facts = [F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col(c).isNull(), 1)).alias("nulls"), F.count(F.when(F.col(c).cast("string") == "", 1)).alias("empties"), F.count_distinct(F.col(c)).alias("distinct_values")) for c in columns]
    return df.agg(F.array(*facts).alias("f")).select(F.explode("f").alias("f")).select("f.*")
