"""Ordered rules: the first that matches decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(column: Column | str, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """Class of the first (pattern, class) whose regular expression is found; the default where none is, or the value is null."""
    c = F.col(column) if isinstance(column, str) else column
    out = F.lit(None).cast("string")
    for pattern, name in reversed(rules):
        out = F.when(c.rlike(pattern), F.lit(name)).otherwise(out)
    return F.coalesce(out, F.lit(default).cast("string"))


def rule_table_match(df: DataFrame, column: str, rules: DataFrame, keys: list[str], prefix: str = "prefix", rank: str = "priority", name: str = "class") -> DataFrame:
    """``df`` with the class of the best rule of a rule table: a value has the class of the rule of least rank whose prefix it begins with.

    Rules are matched by equality on the lengths of prefixes that occur, not by trying
    every rule on every row: each row is expanded to its prefixes of those lengths.
    ``keys`` identify a row. Rows without a rule get null.
    """
    sizes = sorted(r[0] for r in rules.select(F.length(prefix)).distinct().collect())  # as many as there are lengths of prefixes
    heads = df.select(*keys, F.explode(F.array(*[F.when(F.length(column) >= n, F.substring(column, 1, n)) for n in sizes])).alias("_head")).filter("_head is not null")
    best = heads.join(rules.select(F.col(prefix).alias("_head"), F.col(rank).alias("_rank"), F.col(name).alias("_name")), "_head").groupBy(*keys).agg(F.min_by("_name", F.struct("_rank", "_name")).alias(name))
    return df.join(best, keys, "left")


def all_matches(column: Column | str, rules: list[tuple[str, str]]) -> Column:
    """Classes of all rules that match, in the order of the rules."""
    c = F.col(column) if isinstance(column, str) else column
    return F.array_compact(F.array(*[F.when(c.rlike(p), F.lit(n)) for p, n in rules]))


def route(confidence: Column, *flags: Column, threshold: float = 0.8) -> Column:
    """needs_review for low or unknown confidence and for any flag, else auto_ready."""
    bad = F.coalesce(confidence < threshold, F.lit(True))
    for f in flags:
        bad = bad | F.coalesce(f, F.lit(False))
    return F.when(bad, "needs_review").otherwise("auto_ready")
