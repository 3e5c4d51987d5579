"""Groups from pairwise matches: connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.skew import HOT_ROWS, lookup_join
from ..storage import Scratch

#: Blanks of any width around a value.
OUTER_BLANKS = r"(?U)^\s+|\s+$"


def is_action(action: Column, wanted: str) -> Column:
    """Whether an unevenly spelled action is the wanted one, whatever its letter case and outer blanks."""
    return F.lower(F.regexp_replace(action, OUTER_BLANKS, "")) == wanted


def link_pairs(decisions: DataFrame, left: str = "left_ref", right: str = "right_ref", action: str = "action", wanted: str = "merge") -> DataFrame:
    """(u, v) with u > v, once for each pair that some row links; rows without both refs or with equal refs link nothing."""
    given = [F.col(c).isNotNull() & (F.col(c) != "") for c in (left, right)]
    linked = decisions.filter(is_action(F.col(action), wanted) & given[0] & given[1] & (F.col(left) != F.col(right)))
    return linked.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct()


def _large_star(edges: DataFrame, hot_rows: int) -> DataFrame:
    """Each edge (u, v) goes to (u, m), m the least of v and its neighbours. Only nodes that are no minimum themselves are looked up."""
    both = edges.union(edges.select("v", "u"))
    lower = both.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m")).filter(F.col("m") < F.col("v"))
    return lookup_join(edges, lower, "v", "u", "left", hot_rows).select("u", F.coalesce("m", "v").alias("v"))


def _small_star(edges: DataFrame, hot_rows: int) -> DataFrame:
    """The smaller neighbours of u, and u itself, go to the least of them. Only nodes with several are looked up."""
    several = edges.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("x")).filter(F.col("m") < F.col("x"))
    found = lookup_join(edges, several.select("u", "m"), "u", "v", "left", hot_rows)
    # the edge to the minimum itself stays as it is, the others hang their v below it
    return found.select(F.when(F.col("m").isNull() | (F.col("m") == F.col("v")), F.col("u")).otherwise(F.col("v")).alias("u"), F.coalesce("m", "v").alias("v"))


def connected_groups(links: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(ref, group_ref) for every ref of ``links`` (u, v): the least ref that is connected with it.

    Large-star and small-star rewrites alternate until the edges stay unchanged; then
    every ref hangs directly below its least ref. Each rewrite keeps or lowers the
    number of edges, keys with very many edges are spread over tasks, and every
    round is written to the shared folder.

    Defined cases: direction, order and repetition of a pair do not matter; pairs with
    a null or with itself are ignored; an empty table gives an empty result; further
    columns are ignored.
    """
    scratch = Scratch(links.sparkSession, "groups")
    ordered = links.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))

    def put(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        seen = Observation(name)
        told = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("s"))
        return scratch.put(told, name), tuple(seen.get.get(k) for k in ("n", "x", "s"))

    edges, mark = put(ordered.distinct(), "e0")
    done = 0
    while True:
        stars = scratch.put(_large_star(edges, hot_rows), f"s{done}")
        new, now = put(_small_star(stars, hot_rows).distinct(), f"e{done + 1}")
        scratch.drop(f"s{done}")
        scratch.drop(f"e{done}")
        scratch.release()
        if now == mark:
            return new.select(F.col("u").alias("ref"), F.col("v").alias("group_ref")).union(new.select("v", "v").distinct())
        edges, mark, done = new, now, done + 1


def merge_groups(decisions: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(ref, group_ref) of all refs that merge decisions link, see ``link_pairs`` and ``connected_groups``."""
    return connected_groups(link_pairs(decisions), hot_rows)
