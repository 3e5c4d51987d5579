"""Boxes and segments in the plane, found through a grid instead of by all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlapping_boxes(df: DataFrame, key: str, cell: float) -> DataFrame:
    """(left_id, right_id): boxes (key, x, y, w, h) whose insides overlap. Each pair is met in the grid cell of its overlap's corner only."""
    b = df.select(F.col(key).alias("id"), "x", "y", "w", "h").filter((F.col("w") > 0) & (F.col("h") > 0))
    c = b.withColumn("cx", F.explode(F.sequence(F.floor(F.col("x") / cell), F.floor((F.col("x") + F.col("w")) / cell)))).withColumn("cy", F.explode(F.sequence(F.floor(F.col("y") / cell), F.floor((F.col("y") + F.col("h")) / cell))))
    left, right = c.toDF("left_id", "x1", "y1", "w1", "h1", "cx", "cy"), c.toDF("right_id", "x2", "y2", "w2", "h2", "cx", "cy")
    meet = left.join(right, ["cx", "cy"]).filter("left_id < right_id and x1 < x2 + w2 and x2 < x1 + w1 and y1 < y2 + h2 and y2 < y1 + h1")
    corner = (F.floor(F.greatest("x1", "x2") / cell) == F.col("cx")) & (F.floor(F.greatest("y1", "y2") / cell) == F.col("cy"))
    return meet.filter(corner).select("left_id", "right_id").distinct()


def contained_boxes(df: DataFrame, key: str, cell: float) -> DataFrame:
    """(outer_id, inner_id): a box that holds another one whole; equal boxes hold each other."""
    b = df.select(F.col(key).alias("id"), "x", "y", "w", "h").filter((F.col("w") >= 0) & (F.col("h") >= 0))
    outer = b.withColumn("cx", F.explode(F.sequence(F.floor(F.col("x") / cell), F.floor((F.col("x") + F.col("w")) / cell)))).withColumn("cy", F.explode(F.sequence(F.floor(F.col("y") / cell), F.floor((F.col("y") + F.col("h")) / cell)))).toDF("outer_id", "x1", "y1", "w1", "h1", "cx", "cy")
    inner = b.select(F.col("id").alias("inner_id"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("w").alias("w2"), F.col("h").alias("h2"), F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    return outer.join(inner, ["cx", "cy"]).filter("outer_id != inner_id and x1 <= x2 and y1 <= y2 and x2 + w2 <= x1 + w1 and y2 + h2 <= y1 + h1").select("outer_id", "inner_id").distinct()


def bounds(df: DataFrame, by: list[str]) -> DataFrame:
    """(by, left, top, width, height, boxes, width_spread): the box around all boxes, and the spread of widths against their mean."""
    return df.groupBy(*by).agg(F.min("x").alias("left"), F.min("y").alias("top"), (F.max(F.col("x") + F.col("w")) - F.min("x")).alias("width"), (F.max(F.col("y") + F.col("h")) - F.min("y")).alias("height"), F.count(F.lit(1)).alias("boxes"), (F.stddev_pop("w") / F.avg("w")).alias("width_spread"))


def segments_cross(a: tuple[Column, Column], b: tuple[Column, Column], c: tuple[Column, Column], d: tuple[Column, Column]) -> Column:
    """Whether the inner parts of two segments cross."""
    turn = lambda p, q, r: F.signum((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]))
    return (turn(a, b, c) * turn(a, b, d) < 0) & (turn(c, d, a) * turn(c, d, b) < 0)
