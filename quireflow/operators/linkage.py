"""Linking records of two tables by several exact strategies, with explicit conflicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import lookup_join


def link(left: DataFrame, right: DataFrame, left_key: str, right_key: str, strategies: list[tuple[str, Column, Column]]) -> DataFrame:
    """One row for each left record: (left_key, status, strategy, right_key).

    ``strategies`` are (name, expression on left, expression on right), in the order of trust.
    A strategy decides where exactly one right record has the value. Different decisions
    are conflicting-answer; one decision without a strategy of several hits is matched,
    unless an earlier left record has the same answer, then duplicate-answer; without a
    decision it is duplicate-answer for several hits, else missing-answer. Null values hit nothing.

    Each strategy reduces the right side to one row for a value (count and least key)
    before the join, so a value that very many records share cannot blow up.
    """
    hits = []
    for rank, (name, on_left, on_right) in enumerate(strategies):
        index = right.select(on_right.alias("_v"), F.col(right_key).alias("_r")).dropna().distinct().groupBy("_v").agg(F.count(F.lit(1)).alias("_n"), F.min("_r").alias("_r"))
        hits.append(left.select(F.col(left_key).alias("_l"), on_left.alias("_v")).dropna().join(index, "_v").select("_l", F.lit(rank).alias("_k"), F.lit(name).alias("_name"), "_n", "_r"))
    sure = F.col("_n") == 1
    per = reduce(DataFrame.union, hits).groupBy("_l").agg(
        F.count_distinct(F.when(sure, F.col("_r"))).alias("_answers"),
        F.max(F.col("_n") > 1).alias("_many"),
        F.min_by(F.when(sure, F.struct("_name", "_r")), F.when(sure, F.col("_k"))).alias("_best"),
    )
    all_left = left.select(F.col(left_key).alias("_l")).filter("_l is not null").distinct().join(per, "_l", "left")
    one = (F.col("_answers") == 1) & ~F.col("_many")
    # an answer belongs to the least left record that it alone decides; records without a decision take no part
    claim = F.when(F.coalesce(one, F.lit(False)), F.col("_best._r"))
    firsts = all_left.groupBy(claim.alias("_claim")).agg(F.min("_l").alias("_first")).filter("_claim is not null")
    all_left = lookup_join(all_left.withColumn("_claim", claim), firsts, "_claim", "_l", "left")
    claimed = F.col("_first") != F.col("_l")
    status = F.when(F.col("_answers") > 1, "conflicting-answer").when(one & claimed, "duplicate-answer").when(one, "matched").when(F.col("_many"), "duplicate-answer").otherwise("missing-answer")
    found = all_left.withColumn("status", status)
    hit = F.col("status") == "matched"
    return found.select(F.col("_l").alias(left_key), "status", F.when(hit, F.col("_best._name")).alias("strategy"), F.when(hit, F.col("_best._r")).alias(right_key))


def merge_candidates(pairs: DataFrame, left: str, right: str, channel: str, score: str, hard: str) -> DataFrame:
    """Candidate pairs of several channels as one row for each unordered pair.

    (left_id, right_id, channels, score, hard): sorted channels, greatest score, any hard.
    Pairs of an id with itself and with null are dropped.
    """
    ok = pairs.filter(F.col(left) != F.col(right))
    return ok.groupBy(F.least(left, right).alias("left_id"), F.greatest(left, right).alias("right_id")).agg(F.sort_array(F.collect_set(channel)).alias("channels"), F.max(score).alias("score"), F.max(F.coalesce(F.col(hard), F.lit(False))).alias("hard"))


def inverted_index(df: DataFrame, owner: str, targets: str) -> DataFrame:
    """(target, owners, first_owner): of each target how many owners name it, and the least of them."""
    return df.select(owner, F.explode(targets).alias("target")).groupBy("target").agg(F.count_distinct(owner).alias("owners"), F.min(owner).alias("first_owner"))
