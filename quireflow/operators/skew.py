"""Joins that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a single task may still take; a key with more is spread over several.
HOT_ROWS = 100_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(hot_key, salts) of the keys with more than ``hot_rows`` rows.

    Counting combines on the map side. The result has fewer than ``rows / hot_rows``
    rows whatever the distribution, which is the bound for broadcasting it.
    """
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select("hot_key", F.ceil(F.col("_n") / hot_rows).cast("int").alias("salts"))


#: Hot keys that are broadcast at most; more are joined without a hint.
MOST_HOT = 10_000


def hot_side(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The hot keys as a join side: None if there are none, a broadcast of at most ``MOST_HOT`` rows, or the plain table if there are more.

    At most that many keys come to the driver, whatever the size of ``df``.
    """
    found = hot_keys(df, key, hot_rows)
    rows = found.limit(MOST_HOT + 1).collect()
    if not rows:
        return None
    return found if len(rows) > MOST_HOT else F.broadcast(df.sparkSession.createDataFrame(rows, found.schema))


def lookup_join(left: DataFrame, right: DataFrame, key: str, spread_by: str, how: str = "inner", hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Join ``left`` to ``right`` on ``key``, where a key may hold a large part of ``left``.

    A hot key of ``left`` is spread over several tasks by the hash of ``spread_by``;
    its right rows are repeated once for each of them. Null keys match nothing.
    ``hot`` are the hot keys (see ``hot_side``) where they are known already.
    """
    hot = hot_side(left, key, hot_rows) if hot is None else hot
    if hot is None:
        return left.join(right, key, how)
    spread = left.join(hot, left[key] == F.col("hot_key"), "left").withColumn("_salt", F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(spread_by), F.col("salts")).cast("int"))).drop("hot_key", "salts")
    copies = right.join(hot, right[key] == F.col("hot_key"), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("hot_key", "salts")
    return spread.join(copies, [key, "_salt"], how).drop("_salt")
