"""Exact and near duplicates, set similarity joins, containment, vector neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import Scratch
from .sequences import global_rank, top_k
from .skew import lookup_join


def exact_classes(df: DataFrame, key: str, value: Column) -> DataFrame:
    """(key, class_id, copies): rows with equal values share the least key as class; null values are alone."""
    digest = F.coalesce(F.sha2(value, 256), F.concat(F.lit("null:"), F.col(key).cast("string")))
    rows = df.select(F.col(key), digest.alias("_d"))
    classes = rows.groupBy("_d").agg(F.min(key).alias("class_id"), F.count_distinct(key).alias("copies"))
    # a value that very many rows share is counted before the join
    return lookup_join(rows.distinct(), classes, "_d", key).select(key, "class_id", "copies")


def unique_lookup(df: DataFrame, key: str, value: Column) -> DataFrame:
    """(digest, key) of the values that exactly one key has."""
    return df.select(F.sha2(value, 256).alias("digest"), key).dropna().groupBy("digest").agg(F.count_distinct(key).alias("_n"), F.min(key).alias(key)).filter("_n = 1").drop("_n")


def jaccard_join(df: DataFrame, key: str, items: str, least: float) -> DataFrame:
    """(left_id, right_id, similarity): pairs of sets with a Jaccard similarity of at least ``least``, over classes of equal sets.

    Prefix filter: with items ordered by rarity, two sets of such a similarity share one of
    their first ``n - ceil(least * n) + 1`` items; so only those are joined. Equal sets are
    one class, whose least key stands for all (see ``exact_classes`` for the members).
    The rest is verified on whole sets. Empty sets are like nothing.
    """
    sets = df.select(F.col(key).alias("id"), F.array_sort(F.array_distinct(items)).alias("items")).filter(F.size("items") > 0)
    one = sets.groupBy("items").agg(F.min("id").alias("id"))
    rarity = one.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    ranked = one.select("id", F.size("items").alias("size"), F.explode("items").alias("item")).join(rarity, "item").groupBy("id", "size").agg(F.array_sort(F.collect_list(F.struct("n", "item"))).alias("r"))
    prefix = ranked.select("id", "size", F.explode(F.slice("r", F.lit(1), F.col("size") - F.ceil(F.col("size") * least - 1e-9).cast("int") + 1)).alias("p")).select("id", "size", F.col("p.item").alias("item"))
    a, b = prefix.toDF("left_id", "left_size", "item"), prefix.toDF("right_id", "right_size", "item")
    # items that very many prefixes share are joined in blocks
    near = lookup_join(a, b, "item", "left_id").filter((F.col("left_id") < F.col("right_id")) & (F.least("left_size", "right_size") >= F.greatest("left_size", "right_size") * least - 1e-9)).select("left_id", "right_id").distinct()
    full = near.join(one.select(F.col("id").alias("left_id"), F.col("items").alias("_a")), "left_id").join(one.select(F.col("id").alias("right_id"), F.col("items").alias("_b")), "right_id")
    both = F.size(F.array_intersect("_a", "_b"))
    return full.withColumn("similarity", both / (F.size("_a") + F.size("_b") - both)).filter(F.col("similarity") >= least - 1e-9).select("left_id", "right_id", "similarity")


def containment_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, items: str, least: float) -> DataFrame:
    """(left_key, right_key, shared, containment): the part of each left set that stands in a right set, by an inverted index.

    With c = ``least`` a left set of n items must have ``ceil(c * n)`` items that stand in any
    right set at all; of these, a right set that contains enough shares one of the rarest, all but
    ``ceil(c * n) - 1``, so only those are looked up, and the shared items are counted on whole
    sets. Items that stand on one side alone take no further part. A small file may hold sets of
    very many items, which no estimate by its size tells, so rows of items are never broadcast.
    """
    scratch = Scratch(left.sparkSession, "containment")
    sets = left.select(left_key, F.array_distinct(items).alias("_items"))
    a = scratch.put(sets.select(left_key, F.size("_items").alias("_size"), F.explode("_items").alias("_item")), "left").hint("merge")
    # numbers stand for items from here on
    ids = global_rank(a.select("_item").distinct(), [F.col("_item")], "_id").hint("merge")
    b = scratch.put(right.select(right_key, F.explode(F.array_distinct(items)).alias("_item")).join(ids, "_item").select(right_key, "_id"), "right").hint("merge")
    common = b.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).hint("merge")
    need = F.ceil(F.col("_size") * least - 1e-9).cast("int").alias("_need")
    ranked = a.join(ids, "_item").join(common, "_id").groupBy(left_key, "_size").agg(F.array_sort(F.collect_list(F.struct("_n", "_id"))).alias("_r"))
    ranked = scratch.put(ranked.select(left_key, "_size", need, F.col("_r._id").alias("_r")).filter(F.size("_r") >= F.col("_need")), "ranked").hint("merge")
    probe = ranked.select(left_key, "_need", F.explode(F.slice("_r", F.lit(1), F.size("_r") - F.col("_need") + 1)).alias("_id"))
    near = lookup_join(probe, b, "_id", left_key).select(left_key, right_key, "_need").distinct().hint("merge")
    whole = b.groupBy(right_key).agg(F.collect_list("_id").alias("_s")).hint("merge")
    full = near.join(whole, right_key).filter(F.size("_s") >= F.col("_need")).drop("_need").join(ranked, left_key)
    shared = full.withColumn("shared", F.size(F.array_intersect("_r", "_s")).cast("long")).filter(F.col("shared") >= F.col("_need"))
    return shared.select(left_key, right_key, "shared", (F.col("shared") / F.col("_size")).alias("containment"))


def vector_neighbours(queries: DataFrame, base: DataFrame, key: str, vector: str, k: int, block: int = 4096) -> DataFrame:
    """(query_id, neighbour_id, cosine, rank): the ``k`` nearest rows of ``base`` for each query, exactly.

    Queries are broadcast in blocks of ``block``, the base is read once for each block and never
    shuffled as a whole: every task keeps the best ``k`` of all its rows for each query, ties at
    the border included, and only these meet. Vectors of another length than most queries or
    without a norm are left out; ties go to the smaller id.
    """
    spark = base.sparkSession
    schema = f"query_id {queries.schema[key].dataType.simpleString()}, neighbour_id {base.schema[key].dataType.simpleString()}, cosine double"
    ids = queries.select(F.col(key).alias("id"), F.col(vector).alias("v")).dropna()
    widths = ids.groupBy(F.size("v").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").collect()
    if not widths:
        return spark.createDataFrame([], schema + ", rank int")
    width, parts = widths[0].w, max(1, -(-sum(r.n for r in widths) // block))
    out = None
    for part in range(parts):
        rows = ids.filter((F.pmod(F.xxhash64("id"), F.lit(parts)) == part) & (F.size("v") == width)).toPandas()
        if not len(rows):
            continue
        q = np.array(rows.v.tolist(), np.float64)
        norm = np.linalg.norm(q, axis=1)
        sent = spark.sparkContext.broadcast((rows.id.to_numpy()[norm > 0], (q[norm > 0].T / norm[norm > 0]).T))

        def best(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            qid, q = sent.value
            kept = None
            for batch in batches:
                b = np.array(batch.v.tolist(), np.float64).reshape(len(batch), width)
                n = np.linalg.norm(b, axis=1)
                b, bid = (b[n > 0].T / n[n > 0]).T, batch.id.to_numpy()[n > 0]
                if not len(bid):
                    continue
                found = []
                for start in range(0, len(qid), 512):
                    sim = np.round(q[start : start + 512] @ b.T, 9)
                    take = min(k + 1, len(bid))
                    bound = -np.partition(-sim, take - 1, axis=1)[:, take - 1 : take]
                    i, j = np.nonzero(sim >= bound)
                    found.append(pd.DataFrame({"query_id": qid[start + i], "neighbour_id": bid[j], "cosine": sim[i, j]}))
                kept = pd.concat(found if kept is None else [kept, *found], ignore_index=True)
                # ties at the border are kept, the ranking below decides among them
                kept = kept[kept.groupby("query_id").cosine.rank(method="min", ascending=False) <= k + 1]
            if kept is not None:
                yield kept

        one = base.select(F.col(key).alias("id"), F.col(vector).alias("v")).filter(F.size("v") == width).mapInPandas(best, schema)
        out = one if out is None else out.union(one)
    if out is None:
        return spark.createDataFrame([], schema + ", rank int")
    return top_k(out.filter(F.col("query_id") != F.col("neighbour_id")), ["query_id"], [F.desc("cosine"), F.col("neighbour_id")], k)


def containment_class(a: Column, b: Column) -> Column:
    """Class of two containments, those of the first in the second and back."""
    return F.when((a >= 0.9) & (b >= 0.9), "equivalent").when(a >= 0.9, "contained").when(b >= 0.9, "contains").when((a >= 0.5) | (b >= 0.5), "partial").otherwise("divergent")
