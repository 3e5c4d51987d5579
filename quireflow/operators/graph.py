"""Graphs as edge tables: components, circles, reachability, order, redundant edges.

Loops write each round to the shared folder and stop when nothing changes; the driver
sees counts alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..storage import Scratch
from .skew import hot_side, lookup_join


def _counted(scratch: Scratch, df: DataFrame, name: str) -> tuple[DataFrame, int]:
    seen = Observation(name)
    out = scratch.put(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, seen.get["n"]


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): weakly connected components, named by their least node.

    Every node, and the node that is its label, takes the least label among its own and
    its neighbours', then the label of its label; so rounds grow with the logarithm of
    the longest chain.
    """
    scratch = Scratch(edges.sparkSession, "components")
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).dropna()
    both = scratch.put(pairs.union(pairs.select("b", "a")).distinct(), "both")
    labels, at = scratch.put(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "l0"), 0
    hot = hot_side(both, "b")
    while True:
        # the label of each neighbour; neighbours with very many edges are spread by salt
        near = lookup_join(both, labels.withColumnRenamed("node", "b"), "b", "a", hot=hot).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen"))
        # what a node hears goes to its label as well, so that whole trees hang below a smaller one at once
        heard = labels.join(near, "node").select(F.explode(F.array(F.struct("node", "seen"), F.struct(F.col("label").alias("node"), "seen"))).alias("h")).groupBy("h.node").agg(F.min("h.seen").alias("seen"))
        better = scratch.put(labels.join(heard, "node").select("node", "label", F.least("label", "seen").alias("best")), f"b{at}")
        # then the label of the label, which halves long chains
        far = better.select(F.col("node").alias("best"), F.col("best").alias("far")).filter("far < best")
        seen = Observation(f"c{at}")
        done = better.join(far, "best", "left").select("node", F.coalesce("far", "best").alias("next"), "label").observe(seen, F.count(F.when(F.col("next") != F.col("label"), 1)).alias("moved"))
        after = scratch.put(done.select("node", F.col("next").alias("label")), f"l{at + 1}")
        scratch.drop(f"l{at}")
        scratch.drop(f"b{at}")
        labels, at = after, at + 1
        if not seen.get["moved"]:
            return labels.withColumnRenamed("label", "component")


def cycle_members(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node): every node on a circle or with a path into one: what is left when nodes without a way out are removed until none is."""
    scratch = Scratch(edges.sparkSession, "cycles")
    left, n = _counted(scratch, edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).dropna().distinct(), "e0")
    at = 0
    while n:
        rest, m = _counted(scratch, left.join(left.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst"), f"e{at + 1}")
        if m == n:
            break
        left, n, at = rest, m, at + 1
    return left.select(F.col("src").alias("node")).distinct()


def true_cycle_nodes(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node): nodes that can be reached from a circle and reach one; in graphs with one way out of each node exactly those on circles."""
    forth = cycle_members(edges, src, dst)
    back = cycle_members(edges.select(F.col(dst).alias("src"), F.col(src).alias("dst")))
    return forth.join(back, "node", "left_semi")


def reachable(edges: DataFrame, seeds: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(seed, node, hops): all nodes that each seed reaches, with the least number of steps; from ``seeds`` (seed)."""
    scratch = Scratch(edges.sparkSession, "reach")
    e = scratch.put(edges.select(F.col(src).alias("node"), F.col(dst).alias("next")).dropna().distinct(), "edges")
    seen = scratch.put(seeds.select("seed", F.col("seed").alias("node"), F.lit(0).alias("hops")).distinct(), "s0")
    front, at = seen, 0
    while True:
        step = front.join(e, "node").select("seed", F.col("next").alias("node"), F.lit(at + 1).alias("hops")).distinct()
        new, n = _counted(scratch, step.join(seen.select("seed", "node"), ["seed", "node"], "left_anti"), f"f{at}")
        if not n:
            return seen.filter("hops > 0")
        seen = scratch.put(seen.union(new), f"s{at + 1}")
        front, at = new, at + 1


def two_hops(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(src, dst): distinct ends of paths of two edges."""
    a = edges.select(F.col(src).alias("src"), F.col(dst).alias("mid")).distinct()
    b = edges.select(F.col(src).alias("mid"), F.col(dst).alias("dst")).distinct()
    return lookup_join(a, b, "mid", "src").filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()


def redundant_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(src, dst): edges of an acyclic graph beside which a path of two or more edges leads to the same node."""
    e = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).dropna().distinct()
    # only an edge from a node with several ways out to one with several ways in can be redundant, so paths are followed from such nodes alone
    forks = e.groupBy("src").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("src")
    meets = e.groupBy("dst").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("dst")
    tested = e.join(forks, "src", "left_semi")
    reached = reachable(e, tested.select(F.col("dst").alias("seed")).distinct()).join(meets.select(F.col("dst").alias("node")), "node", "left_semi")
    further = tested.join(reached.select(F.col("seed").alias("mid"), F.col("node").alias("end")), F.col("dst") == F.col("mid")).select(F.col("src"), F.col("end").alias("dst")).distinct()
    return tested.join(further, ["src", "dst"], "left_semi")


def topological_levels(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, level): the round in which a node has no way in any more; nodes on and behind circles have level -1."""
    scratch = Scratch(edges.sparkSession, "topo")
    e = scratch.put(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).dropna().distinct(), "e")
    nodes = scratch.put(e.select(F.col("src").alias("node")).union(e.select("dst")).distinct(), "n")
    left, parts, at = e, [], 0
    rest = nodes
    while True:
        free, n = _counted(scratch, rest.join(left.select(F.col("dst").alias("node")).distinct(), "node", "left_anti"), f"f{at}")
        if not n:
            break
        parts.append(free.withColumn("level", F.lit(at)))
        rest = scratch.put(rest.join(free, "node", "left_anti"), f"r{at}")
        left = scratch.put(left.join(free.withColumnRenamed("node", "src"), "src", "left_anti"), f"l{at}")
        at += 1
    out = rest.withColumn("level", F.lit(-1))
    for p in parts:
        out = out.union(p)
    return out


def export_bundle(nodes: list[tuple[str, DataFrame, str]], edges: list[tuple[str, DataFrame, str, str]]) -> tuple[DataFrame, DataFrame]:
    """Node rows (label, key) and edge rows (type, from_key, to_key) of several tables."""
    n = [df.select(F.lit(label).alias("label"), F.concat_ws(":", F.lit(label), F.col(k).cast("string")).alias("key")).distinct() for label, df, k in nodes]
    e = [df.select(F.lit(kind).alias("type"), F.col(a).cast("string").alias("from_key"), F.col(b).cast("string").alias("to_key")).distinct() for kind, df, a, b in edges]
    join = lambda xs: xs[0] if len(xs) == 1 else xs[0].union(join(xs[1:]))
    return join(n), join(e)


def greedy_degree_cap(pairs: DataFrame, most: int) -> DataFrame:
    """Soft pairs (id, left_id, right_id, score) in order of score; each is kept while both ends have fewer than ``most``.

    The greedy choice is found in rounds: a pair is decided as soon as it is among the
    best ``most`` undecided pairs of both its ends, which needs no fold over all pairs.
    """
    scratch = Scratch(pairs.sparkSession, "cap")
    left, n = _counted(scratch, pairs.select("id", "left_id", "right_id", "score"), "p0")
    kept, at = [], 0
    used = None
    while n:
        ends = left.select("id", "score", F.explode(F.array("left_id", "right_id")).alias("end"))
        if used is not None:
            ends = ends.join(used, "end", "left")
        free = F.lit(most) - (F.coalesce("used", F.lit(0)) if used is not None else F.lit(0))
        ranked = ends.withColumn("_r", F.row_number().over(Window.partitionBy("end").orderBy(F.desc("score"), "id"))).withColumn("_free", free)
        good = ranked.groupBy("id").agg(F.min((F.col("_r") <= F.col("_free")).cast("int")).alias("safe"), F.max((F.col("_free") <= 0).cast("int")).alias("full"))
        state = scratch.put(left.join(good, "id"), f"g{at}")
        now, _ = _counted(scratch, state.filter("safe = 1").select("id", "left_id", "right_id", "score"), f"k{at}")
        kept.append(now)
        before = n
        left, n = _counted(scratch, state.filter("safe = 0 and full = 0").select("id", "left_id", "right_id", "score"), f"p{at + 1}")
        full = kept[0]
        for k in kept[1:]:
            full = full.union(k)
        used = scratch.put(full.select(F.explode(F.array("left_id", "right_id")).alias("end")).groupBy("end").agg(F.count(F.lit(1)).cast("int").alias("used")), f"u{at}")
        at += 1
        if n == before:
            raise RuntimeError("no pair could be decided")
    out = kept[0] if kept else pairs.select("id", "left_id", "right_id", "score")
    for k in kept[1:]:
        out = out.union(k)
    return out
