"""Records in running text: numbered items and sections found by the lines with which they begin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def segment(lines: DataFrame, by: list[str], order: str, starts: Column, name: str = "record") -> DataFrame:
    """``lines`` with ``name``: the number of the record within its context, from 1; 0 before the first line that ``starts`` one.

    A null start counts as none. One sort for each context.
    """
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(name, F.coalesce(F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(w), F.lit(0)))


def bodies(lines: DataFrame, by: list[str], order: str, text: str) -> DataFrame:
    """(by, first_line, last_line, body): the lines of each record joined again, in order."""
    ordered = F.array_sort(F.collect_list(F.struct(order, text)))
    out = lines.groupBy(*by).agg(F.min(order).alias("first_line"), F.max(order).alias("last_line"), ordered.alias("_l"))
    return out.select(*by, "first_line", "last_line", F.array_join(F.transform("_l", lambda x: x[text]), "\n").alias("body"))


def inherit(lines: DataFrame, by: list[str], order: str, value: Column, name: str) -> DataFrame:
    """``lines`` with the last non-null ``value`` up to each line, such as the heading that it stands under."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn(name, F.last(value, ignorenulls=True).over(w))
