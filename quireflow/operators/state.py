"""Incremental state: digests, differences, identifiers that stay, caches and chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequences import global_rank


def row_digest(*columns: Column | str) -> Column:
    """SHA-256 of the values with nulls marked, so that null and empty differ."""
    parts = [F.coalesce(F.concat(F.lit("="), (F.col(c) if isinstance(c, str) else c).cast("string")), F.lit("~")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def table_digest(df: DataFrame, by: list[str], digest: str) -> DataFrame:
    """(by, rows, digest) of whole groups, whatever the order of rows and without gathering them: sums of digests modulo 2**60 in four parts.

    Equal groups have equal digests; each row adds, so repeated rows count.
    """
    parts = [F.sum(F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")) % F.lit(1 << 60).cast("decimal(38,0)") for k in range(4)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sha2(F.concat_ws("/", *parts), 256).alias("digest"))


def three_way_state(base: DataFrame, seen: DataFrame, now: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, state) against the adopted and the last applied version: missing, unknown, unchanged, updated, manually_modified.

    ``base`` holds what was applied last, ``seen`` what is wanted, ``now`` what is there.
    """
    b = base.select(key, F.col(digest).alias("_b"))
    s = seen.select(key, F.col(digest).alias("_s"))
    n = now.select(key, F.col(digest).alias("_n"))
    state = F.when(F.col("_n").isNull(), "missing").when(F.col("_b").isNull(), "unknown").when(F.col("_n") != F.col("_b"), "manually_modified").when(F.col("_s").isNull() | (F.col("_s") == F.col("_b")), "unchanged").otherwise("updated")
    return b.join(s, key, "full_outer").join(n, key, "full_outer").select(key, state.alias("state"))


def changes(old: DataFrame, new: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, change): added, removed, changed; unchanged keys are left out."""
    o, n = old.select(key, F.col(digest).alias("_o")), new.select(key, F.col(digest).alias("_n"))
    kind = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(F.col("_o") != F.col("_n"), "changed")
    return o.join(n, key, "full_outer").select(key, kind.alias("change")).filter("change is not null")


def allocate_ids(known: DataFrame, wanted: DataFrame, identity: str, number: str) -> DataFrame:
    """(identity, number, fresh): a known identity keeps its number, the others get the next free ones in order of identity."""
    kept = known.select(identity, number).dropna().groupBy(identity).agg(F.min(number).alias(number))
    top = kept.agg(F.coalesce(F.max(number), F.lit(0)).alias("m")).first().m
    ids = wanted.select(identity).dropna().distinct()
    old = ids.join(kept, identity).withColumn("fresh", F.lit(False))
    new = global_rank(ids.join(kept, identity, "left_anti"), [F.col(identity)], "_r").select(identity, (F.col("_r") + F.lit(top)).cast("long").alias(number), F.lit(True).alias("fresh"))
    return old.select(identity, F.col(number).cast("long").alias(number), "fresh").union(new)


def upsert(table: DataFrame, rows: DataFrame, keys: list[str], version: str) -> DataFrame:
    """``table`` with ``rows`` merged in: of each key the row of the latest version stays, the one of ``rows`` on ties."""
    both = table.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    latest = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(version), F.col("_new"))).alias("r"))
    return latest.select(*keys, "r.*").drop("_new")


def first_decisions(decisions: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """The first decision of each key."""
    return decisions.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value))


def chain_breaks(df: DataFrame, by: list[str], order: list[str], before: str, after: str) -> DataFrame:
    """(by, at): rows whose state before is not the state after the last row."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("at", F.row_number().over(w)).withColumn("_last", F.lag(after).over(w)).filter((F.col("at") > 1) & ~F.col("_last").eqNullSafe(F.col(before))).select(*by, "at")


def current(stages: DataFrame, key: str, order: list[str], status: str, fingerprint: str, wanted: DataFrame) -> DataFrame:
    """(key, reusable): whether the latest attempt of each stage is completed with the wanted fingerprint."""
    latest = stages.groupBy(key).agg(F.max_by(F.struct(status, fingerprint), F.struct(*order)).alias("r"))
    ok = (F.col(f"r.{status}") == "completed") & (F.col(f"r.{fingerprint}") == F.col("_w"))
    return wanted.select(key, F.col(fingerprint).alias("_w")).join(latest, key, "left").select(key, F.coalesce(ok, F.lit(False)).alias("reusable"))
