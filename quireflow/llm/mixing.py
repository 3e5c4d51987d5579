"""Mixing sources to target shares of all tokens by entropy balancing.

Every document gets a rate, its expected number of copies. Among all rates that meet
the constraints, entropy balancing takes those nearest to the base rates (all documents
used alike whatever their source, at the size that the scarcest source allows): exponentially
tilted rates, bounded by the source's cap, ``rate / (cap - rate) = base / (cap - base) *
exp(sum of the multipliers of the document's constraints)``. The distance is counted by
tokens, so that no document is preferred for being short or long. Constraints are the
tokens of each source and, where a margin is given (such as the language), the tokens of each of
its values; the two meet in the same documents, so the dual is then solved jointly by damped
Newton steps with a full Hessian. Without a margin the dual has one multiplier for each source. Rates depend on a document's source and margin alone: one
distributed aggregation gives the tokens of each such cell, on which all steps work.
Rates become whole copies by systematic rounding, which keeps each source's tokens.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import Scratch

#: Folder of the public tokenizers, and the one whose tokens are counted.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.tiktoken"
# The pattern that cuts text into pieces for this byte-level vocabulary.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Size classes of documents for each unit of the logarithm of their tokens, and the documents that one part of a class has on average.
CLASSES, PART_ROWS = 24, 100_000
#: Offsets of the rounding that are compared.
OFFSETS = 16
TOLERANCE, MAX_STEPS = 1e-10, 100
#: Bounds of the base rate in its cap; the multiplier of a source makes up for them.
LEVELS = (0.001, 0.999)
#: Greatest multiplier of a source; rates beyond it are 0 or the cap.
REACH = 700.0
#: How firmly the margin is met, in the share of its tokens by which a multiplier of one may miss it; sources are met exactly.
SOFT = 1e-6


def source_name(source: Column) -> Column:
    """A source whatever its letter case, outer blanks and word divider."""
    return F.regexp_replace(F.lower(F.regexp_replace(source, r"(?U)^\s+|\s+$", "")), r"(?U)[\s\-]+", "_")


def count_tokens(docs: DataFrame, text: str = "text", out: str = "tokens", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with the number of tokens of ``text``; null for null, 0 for an empty text. The vocabulary is read once here and broadcast (a file of fixed size), so executors need no copy of the folder."""
    with open(f"{folder}/{vocabulary}", "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
    kept: list = []

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        if not kept:
            import tiktoken

            kept.append(tiktoken.Encoding("mixing", pat_str=PIECES, mergeable_ranks=ranks.value, special_tokens={}))
        return pd.Series([None if t is None else len(kept[0].encode_ordinary(t)) for t in texts], dtype="Int64")

    return docs.withColumn(out, tokens(F.col(text)))


def solve_total(capacity: dict[str, float], share: dict[str, float]) -> tuple[float, dict[str, float]]:
    """The largest total that all present sources can fill at their shares, and the tokens of each.

    Sources without documents cannot be filled; their share is divided among the others
    in proportion, and reported as not reached.
    """
    present = {s: share[s] for s in share if share[s] > 0 and capacity.get(s, 0) > 0}
    whole = sum(present.values())
    if not whole:
        return 0.0, {}
    total = min(capacity[s] * whole / w for s, w in present.items())
    return total, {s: total * w / whole for s, w in present.items()}


def balance(cells: dict[tuple[str, str | None], float], goals: dict[str, float], caps: dict[str, int], margin: dict[str, float] | None = None) -> dict[tuple[str, str | None], float]:
    """The rate of each cell (source, margin value), from the tokens of the cells.

    Minimises the entropy of the rates to their base by tokens under the constraints: the
    convex dual is solved for each source by itself, and from there, where a margin is given, by joint
    Newton steps with halving where a step does not lower it.
    ``margin`` are the shares of all tokens that the margin's values should have; it is met as
    far as caps and sources allow.
    """
    keys = [k for k in sorted(cells, key=repr) if k[0] in goals and cells[k] > 0]
    sources = sorted({s for s, _ in keys})
    values = sorted({v for _, v in keys}, key=repr)[1:] if margin else []  # the shares of the others fix the first
    if not keys:
        return {}
    tokens, cap = np.array([cells[k] for k in keys]), np.array([float(caps[s]) for s, _ in keys])
    have = {s: sum(cells[k] for k in keys if k[0] == s) for s in sources}
    used = np.array([min(goals[s] / have[s] / max(caps[s], 1), 1.0) for s, _ in keys])
    fixed = (used >= 1 - 1e-12) | (used <= 0)  # sources used up or not at all leave no choice
    # without targets all documents would be used alike; the multipliers of the sources lead from there to the goals
    alike = sum(goals[s] for s in sources) / sum(have.values())
    base = np.where(fixed, used, np.clip(alike / np.maximum(cap, 1), *LEVELS))
    bias = np.log(np.clip(base, 1e-300, None)) - np.log(np.clip(1 - base, 1e-300, None))
    member = np.array([[float(k[0] == s) for s in sources] + [float(k[1] == v) for v in values] for k in keys])
    total = sum(goals[s] for s in sources)
    whole = sum(margin.values()) if margin else 1.0
    want = np.array([goals[s] for s in sources] + [total * margin.get(v, 0.0) / whole for v in values])
    scale, ridge = want.sum(), np.array([0.0] * len(sources) + [SOFT * total] * len(values))

    def rates(at: np.ndarray) -> np.ndarray:
        x = np.clip(bias + member @ at, -700, 700)
        return np.where(fixed, cap * base, cap / (1 + np.exp(-x)))

    def dual(at: np.ndarray) -> float:
        x = bias + member @ at
        return float((np.where(fixed, cap * base * x, cap * np.logaddexp(0, x)) * tokens).sum() - want @ at + 0.5 * (ridge * at * at).sum())

    at, n = np.zeros(member.shape[1]), len(sources)
    # the multiplier of each source alone, by halving: exact whatever the sizes; where a margin is given the joint steps start there
    free = member[~fixed, :n].any(axis=0)
    low, high = np.where(free, -REACH, 0.0), np.where(free, REACH, 0.0)
    for _ in range(MAX_STEPS):
        at[:n] = (low + high) / 2
        more = (member[:, :n].T @ (rates(at) * tokens)) < want[:n]
        low, high = np.where(more, at[:n], low), np.where(more, high, at[:n])
    at[:n] = (low + high) / 2
    for _ in range(MAX_STEPS):
        r = rates(at)
        gradient = member.T @ (r * tokens) - want + ridge * at
        if np.abs(gradient).max() <= TOLERANCE * scale:
            break
        slope = np.where(fixed, 0.0, r * (1 - r / cap) * tokens)
        hessian = (member.T * slope) @ member + np.diag(ridge + 1e-12 * scale)
        step, now, t = np.linalg.solve(hessian, gradient), dual(at), 1.0
        while t > 1e-9 and dual(at - t * step) > now - 1e-4 * t * float(gradient @ step):
            t /= 2
        at = at - t * step
    return dict(zip(keys, rates(at).tolist()))


def mix_sources(docs: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY, margin: str | None = None, margin_shares: dict[str, float] | None = None) -> tuple[DataFrame, DataFrame]:
    """Chosen documents with their copies, and the shares reached.

    The first table has ``key``, ``source``, ``tokens``, ``rate``, ``copies`` (documents with
    no copy are left out); the second for each target source ``target_share``,
    ``n_docs``, ``available_tokens``, ``largest_tokens``, ``goal_tokens``, ``mixed_tokens``, ``actual_share``, ``max_repeats``, ``most_copies``.
    The mix is as large as the scarcest source allows at its cap. With ``margin``, a
    column of few values, and ``margin_shares`` the values' shares of all tokens are balanced as well.

    Defined cases: null and empty texts and texts without a known source take no part;
    a target without documents gets nothing and its share goes to the others in
    proportion; sources without a target take no part; repeated target rows count
    once, of different ones the larger share and cap count; a null share is 0 and a null
    cap 1; repeated rows of documents are documents of their own; a null margin is a value of its own.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    goal = {r.source: (r.share, r.cap) for r in targets.select(source_name(F.col("source")).alias("source"), F.coalesce("target_share", F.lit(0.0)).alias("share"), F.coalesce("max_repeats", F.lit(1)).alias("cap")).filter("source is not null").groupBy("source").agg(F.max("share").alias("share"), F.max("cap").alias("cap")).collect()}
    value = F.lit(None).cast("string") if margin is None else F.col(margin).cast("string")
    known = docs.select(F.col(key).alias("key"), source_name(F.col("source")).alias("source"), value.alias("margin"), F.col(text).alias("text")).filter(F.col("text") != "").filter(F.col("source").isin(list(goal)))
    sizes = scratch.put(count_tokens(known, folder=folder, vocabulary=vocabulary).select("key", "source", "margin", "tokens").filter("tokens > 0"), "sizes")
    # all that the solution needs: tokens by cell, and the documents of each size class
    size = F.floor(F.log("tokens") * CLASSES).cast("int")
    classes = scratch.put(sizes.groupBy("source", "margin", size.alias("size")).agg(F.sum("tokens").alias("t"), F.max("tokens").alias("x"), F.count(F.lit(1)).alias("n")), "classes")
    cells = {(r.source, r.margin): r.t for r in classes.groupBy("source", "margin").agg(F.sum("t").alias("t")).collect()}
    have = {r.source: (r.t, r.n, r.x) for r in classes.groupBy("source").agg(F.sum("t").alias("t"), F.sum("n").alias("n"), F.max("x").alias("x")).collect()}
    caps = {s: max(0, int(c)) for s, (_, c) in goal.items()}
    _, wanted = solve_total({s: t * caps[s] for s, (t, *_) in have.items()}, {s: w for s, (w, _) in goal.items()})
    found = balance(cells, wanted, caps, margin_shares if margin else None)
    rates = spark.createDataFrame([(s, v, float(r), caps[s]) for (s, v), r in found.items()], "source string, margin string, rate double, cap int")
    parts = classes.groupBy("source", "size").agg(F.ceil(F.sum("n") / PART_ROWS).cast("int").alias("parts"))
    # both tables have at most one row for each source and value or size class
    rated = sizes.withColumn("size", size).join(F.broadcast(rates), (sizes["source"] == rates["source"]) & sizes["margin"].eqNullSafe(rates["margin"])).drop(rates["source"]).drop(rates["margin"])
    rated = rated.join(F.broadcast(parts), ["source", "size"]).select("key", "source", "tokens", "cap", "rate", "size", F.pmod(F.xxhash64("key", "tokens"), F.col("parts")).cast("int").alias("part"))
    chosen = _round(scratch.put(rated, "rated"), wanted, scratch)
    return chosen.withColumnRenamed("key", key), _report(spark, chosen, goal, have, wanted)


def _round(rated: DataFrame, wanted: dict[str, float], scratch: Scratch) -> DataFrame:
    """Whole copies: of documents in order of size each takes the whole part of its rate, and one copy more where the running sum of the fractions passes a whole number.

    Neighbours are alike in size, so a copy stands for the fractions of documents as large
    as itself, and the tokens of a source miss their goal by one document at most for
    each part. Size classes have parts only where they are large, so no task orders a whole
    source; the running sum of a part starts where the one before it ends. Of several
    offsets of the sum the one that comes nearest to the goal is taken.
    """
    from pyspark.sql import Window

    whole = F.floor("rate")
    parts = rated.withColumn("base", whole.cast("int")).withColumn("rest", F.col("rate") - whole)
    ends = parts.groupBy("source", "size", "part").agg(F.sum("rest").alias("rest"))
    starts = ends.withColumn("start", F.sum("rest").over(Window.partitionBy("source").orderBy("size", "part").rowsBetween(Window.unboundedPreceding, -1))).select("source", "size", "part", F.coalesce("start", F.lit(0.0)).alias("start"))
    run = Window.partitionBy("source", "size", "part").orderBy("tokens", "key")
    summed = scratch.put(parts.join(starts, ["source", "size", "part"]).withColumn("upto", F.col("start") + F.sum("rest").over(run.rowsBetween(Window.unboundedPreceding, 0))).select("key", "source", "tokens", "rate", "cap", "base", "rest", "upto"), "summed")
    copies = lambda offset: F.least(F.col("base") + (F.floor(F.col("upto") + offset + 1e-9) - F.floor(F.col("upto") - F.col("rest") + offset + 1e-9)).cast("int"), F.col("cap"))
    offsets = [(k + 0.5) / OFFSETS for k in range(OFFSETS)]
    got = summed.groupBy("source").agg(F.array(*[F.sum(copies(F.lit(u)) * F.col("tokens")) for u in offsets]).alias("got")).collect()
    best = {r.source: min(range(OFFSETS), key=lambda k: (abs(r.got[k] - wanted[r.source]), abs(offsets[k] - 0.5))) for r in got}
    at = scratch.spark.createDataFrame([(s, offsets[k]) for s, k in best.items()], "source string, offset double")
    out = summed.join(F.broadcast(at), "source").withColumn("copies", copies(F.col("offset"))).filter("copies > 0")
    return scratch.put(out.select("key", "source", "tokens", "rate", "copies"), "chosen")


def _report(spark, chosen: DataFrame, goal: dict, have: dict, wanted: dict) -> DataFrame:
    targets = spark.createDataFrame([(s, float(w), int(c), *(int(have.get(s, (0, 0, 0))[k]) for k in (1, 0, 2)), float(wanted.get(s, 0.0))) for s, (w, c) in sorted(goal.items())], "source string, target_share double, max_repeats int, n_docs long, available_tokens long, largest_tokens long, goal_tokens double")
    got = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"), F.max("copies").alias("most_copies"))
    whole = got.agg(F.sum("mixed_tokens")).first()[0] or 1
    out = targets.join(F.broadcast(got), "source", "left")
    return out.select("source", "target_share", "max_repeats", "n_docs", "available_tokens", "largest_tokens", "goal_tokens", F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), F.coalesce(F.col("mixed_tokens") / F.lit(float(whole)), F.lit(0.0)).alias("actual_share"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
