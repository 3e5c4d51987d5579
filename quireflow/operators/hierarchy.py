"""Parent-child rows of unknown depth as full hierarchies.

Leaves are peeled from the bottom, round by round: every round sends the subtree
sizes of its leaves to their parents. Nodes that are left when a round finds no
leaf lie on circles. In reverse peel order every node then takes root, depth and
path from its parent, which was peeled later and so is known already.

Going up, a job of one or several rounds reads the nodes that are left and no others.
Going down, a job resolves all nodes of one job of the way up: a node that is resolved is
written once for each earlier job in which it has children, so that a job reads just the
nodes that it needs; chains inside the job are followed by doubling pointers. All jobs
together read a small multiple of the table. Nothing is gathered in one task: descendants
are rows, not lists, and what points to one node in very large numbers is spread by salt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..storage import Scratch
from .skew import HOT_ROWS, hot_side


def _edges(nodes: DataFrame, key: str, parent: str, scratch: Scratch, hot_rows: int) -> DataFrame:
    """One row for each key: its parent (null for a root), its salt below it, and the salts of its own children."""
    one = nodes.select(F.col(key).alias("key"), F.nullif(F.col(parent), F.lit("")).alias("parent")).filter(F.col("key").isNotNull()).groupBy("key").agg(F.min("parent").alias("parent"))
    one = scratch.put(one, "keys")
    known = one.filter(F.col("parent").isNotNull()).groupBy("parent").agg(F.count(F.lit(1)).alias("fan")).join(one.select(F.col("key").alias("parent")), "parent", "left_semi")
    known = scratch.put(known, "parents")
    hot = hot_side(one, "parent", hot_rows)
    if hot is None:
        edges = one.join(known.select("parent", F.lit(True).alias("known")), "parent", "left").select("key", F.when(F.col("known"), F.col("parent")).alias("parent"), F.lit(0).alias("salt"), F.lit(1).alias("salts"), F.lit(1).cast("long").alias("size"))
    else:
        below = one.join(hot, F.col("parent") == F.col("hot_key"), "left").withColumn("salt", F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("key"), F.col("salts")).cast("int"))).drop("hot_key", "salts")
        copies = known.join(hot, F.col("parent") == F.col("hot_key"), "left").select("parent", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"), F.lit(True).alias("known"))
        edges = below.join(copies, ["parent", "salt"], "left").select("key", F.when(F.col("known"), F.col("parent")).alias("parent"), "salt")
        edges = edges.join(hot, F.col("key") == F.col("hot_key"), "left").select("key", "parent", "salt", F.coalesce("salts", F.lit(1)).alias("salts"), F.lit(1).cast("long").alias("size"))
    edges = scratch.put(edges, "edges")
    scratch.drop("keys")
    scratch.drop("parents")
    return edges


#: Rounds of peeling in one Spark job: single rounds while the table shrinks fast, longer runs of rounds on the rest.
PEEL_RUNS = (1, 1, 2, 4, 8)


def _round(state: DataFrame, at: int, job: int) -> DataFrame:
    """One round: every node sends itself and one message to its parent, and a node that hears of no living child is peeled.

    Messages are combined before the shuffle, so a parent with very many children is no hot key.
    They tell as well in which job a child was peeled.
    """
    null = lambda kind: F.lit(None).cast(kind)
    own = F.struct("key", "parent", "salt", "salts", "size", "peeled", F.lit(False).alias("alive"), null("int").alias("child"), "jobs")
    told = F.struct(F.col("parent").alias("key"), null("string").alias("parent"), null("int").alias("salt"), null("int").alias("salts"), F.when(F.col("peeled").isNull(), F.lit(0)).otherwise(F.col("size")).alias("size"), null("int").alias("peeled"), F.col("peeled").isNull().alias("alive"), F.when(F.col("peeled").isNotNull(), F.lit(job if at else job - 1)).alias("child"), null("array<int>").alias("jobs"))
    tells = F.col("parent").isNotNull() & (F.col("peeled").isNull() | (F.col("peeled") == at - 1))
    sent = state.select(F.explode(F.when(tells, F.array(own, told)).otherwise(F.array(own))).alias("m")).select("m.*")
    got = sent.groupBy("key").agg(F.max("parent").alias("parent"), F.max("salt").alias("salt"), F.max("salts").alias("salts"), F.sum("size").alias("size"), F.max("peeled").alias("peeled"), F.max("alive").alias("alive"), F.max("jobs").alias("jobs"), F.max("child").alias("child"))
    # all children that are heard of in a round were peeled in one job, so the greatest number is the only one
    jobs = F.when(F.col("child").isNull(), F.col("jobs")).otherwise(F.array_union("jobs", F.array("child")))
    # a message to a node that went in an earlier job has no row of its own; such nodes are final and hear nothing
    return got.filter(F.col("salts").isNotNull()).select("key", "parent", "salt", "salts", "size", F.coalesce("peeled", F.when(~F.col("alive"), F.lit(at))).alias("peeled"), jobs.alias("jobs"))


PEELED = "key string, parent string, salt int, salts int, size long, peeled int, jobs array<int>"


def _peel(edges: DataFrame, scratch: Scratch) -> tuple[list[tuple[str, int]], DataFrame | None]:
    """(table, rounds) of the jobs in peel order; the nodes on circles, or None.

    A table is split into the nodes that are left, those peeled in the last round, whose
    sizes the next job sends on, and those peeled before. ``jobs`` are the jobs in which
    children of a node were peeled.
    """
    spark, done = edges.sparkSession, []
    state = edges.withColumns({"peeled": F.lit(None).cast("int"), "jobs": F.array().cast("array<int>")})
    while True:
        run = PEEL_RUNS[min(len(done), len(PEEL_RUNS) - 1)]
        for k in range(run):
            state = _round(state, k, len(done))
        name, seen = f"peel{len(done)}", Observation(f"peel{len(done)}")
        state = state.observe(seen, F.count(F.when(F.col("peeled").isNull(), 1)).alias("left"), F.count(F.when(F.col("peeled") >= 0, 1)).alias("gone"))
        part = F.when(F.col("peeled").isNull(), "left").when(F.col("peeled") == run - 1, "last").when(F.col("peeled") >= 0, "gone").otherwise("old")
        state.withColumn("part", part).filter("part != 'old'").write.partitionBy("part").option("compression", "zstd").parquet(scratch.path(name))
        left, gone = seen.get["left"], seen.get["gone"]
        if gone:
            done.append((name, run))
        parts = [p for p in ("left", "last") if scratch.exists(f"{name}/part={p}")]
        if not left:
            return done, None
        if not gone or "last" not in parts:
            return done, spark.read.schema(PEELED).parquet(scratch.path(f"{name}/part=left"))
        state = spark.read.schema(PEELED).parquet(*[scratch.path(f"{name}/part={p}") for p in parts]).withColumn("peeled", F.when(F.col("peeled").isNotNull(), F.lit(-1)))


def _circles(ring: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, root) of nodes on circles; root is the smallest key of the circle, found by doubling pointers."""
    state, rounds, name = ring.select("key", F.col("parent").alias("to"), F.col("key").alias("root")), 0, ""
    while True:
        seen = Observation(f"ring{rounds}")
        far = state.select(F.col("key").alias("to"), F.col("to").alias("far"), F.col("root").alias("far_root"))
        new = state.join(far, "to").select("key", F.col("far").alias("to"), F.least("root", "far_root").alias("root"), (F.col("far_root") < F.col("root")).alias("moved")).observe(seen, F.count(F.when(F.col("moved"), 1)).alias("moved"))
        state = scratch.put(new.select("key", "to", "root", "moved"), f"ring{rounds}").drop("moved")
        if name:
            scratch.drop(name)
        name = f"ring{rounds}"
        if not seen.get["moved"]:
            return state.select("key", "root")
        rounds += 1


def resolve_hierarchy(nodes: DataFrame, key: str = "key", parent: str = "parent_key", paths: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Root, depth, path and subtree size of every node of a parent-child table.

    Returns one row for each distinct key: ``node_key``, ``parent_key`` (null for a
    root), ``root_key``, ``depth`` (0 for a root), ``path`` (keys from the root to the
    node), ``subtree_size`` (the node and all below it), ``on_cycle``. With
    ``paths=False`` the column ``path`` is left out.

    Defined cases: a null key is no node. A parent that is null, empty or no key of
    the table makes a root. Repeated rows count once; of several parents of one key
    the smallest counts. A node on or below a circle has depth -1, no path, and as
    root the smallest key on the circle; on the circle the subtree size is null.
    An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    spark = nodes.sparkSession
    scratch = Scratch(spark, "hierarchy")
    edges = _edges(nodes, key, parent, scratch, hot_rows)
    levels, ring = _peel(edges, scratch)
    scratch.drop("edges")
    result = "node_key string, parent_key string, root_key string, depth int, subtree_size long, on_cycle boolean, salts int" + ", path array<string>" * paths
    columns = [c.split()[0] for c in result.split(", ")]

    def keep(df: DataFrame, job: int) -> None:
        # one row for the result, and one for each other job in which the node has children
        needs = F.concat(F.array(F.lit(-1)), F.filter("jobs", lambda j: j != job))
        df.select(*columns, F.explode(needs).alias("need")).write.mode("append").partitionBy("need").option("compression", "zstd").parquet(scratch.path("known"))

    def known(job: int) -> DataFrame | None:
        at = f"known/need={job}"
        return spark.read.schema(result).parquet(scratch.path(at)) if scratch.exists(at) else None

    if ring is not None:
        roots = _circles(ring, scratch)
        no_path = [F.lit(None).cast("array<string>").alias("path")] * paths
        keep(ring.join(roots, "key").select(F.col("key").alias("node_key"), F.col("parent").alias("parent_key"), F.col("root").alias("root_key"), F.lit(-1).alias("depth"), F.lit(None).cast("long").alias("subtree_size"), F.lit(True).alias("on_cycle"), "salts", *no_path, "jobs"), -1)
    for job in reversed(range(len(levels))):
        name, run = levels[job]
        at = [scratch.path(f"{name}/part={p}") for p in ("gone", "last") if scratch.exists(f"{name}/part={p}")]
        keep(_down(spark.read.schema(PEELED).parquet(*at), known(job), run, paths, hot_rows), job)
        scratch.drop(f"known/need={job}")
        scratch.drop(name)
    done = known(-1)
    return (spark.createDataFrame([], result) if done is None else done).drop("salts")


def _down(level: DataFrame, above: DataFrame | None, run: int, paths: bool, hot_rows: int) -> DataFrame:
    """The nodes of one job of peeling with root, depth and path, from ``above``, the resolved parents outside the job.

    ``top`` is the highest node of the job that is known to lie above a node, ``up`` its
    parent, ``n`` the steps from it. A chain inside the job has at most ``run`` nodes, so
    that doubling finds its top in a few joins.
    """
    spread = lambda c: F.greatest(F.ceil(F.coalesce(c, F.lit(1)) / F.lit(hot_rows)).cast("int"), F.lit(1))
    copies = lambda df, n: df.withColumn("at", F.explode(F.sequence(F.lit(0), n - 1)))
    state = level.select("key", "parent", "salts", "size", "jobs", F.col("parent").alias("up"), F.col("salt").alias("at"), F.col("key").alias("top"), F.lit(0).alias("n"), *[F.array("key").alias("tail")] * paths)
    if above is not None:
        above = above.select(F.col("node_key").alias("up"), F.col("root_key").alias("up_root"), F.col("depth").alias("up_depth"), *[F.col("path").alias("up_path")] * paths, "subtree_size", F.col("salts").alias("up_salts"))
    fan = F.col("up_salts")
    if run > 1:
        # no more nodes point to one, over any number of steps, than lie below it; so its size tells the salts
        sizes = level.select(F.col("key").alias("up"), "salts", spread(F.col("size")).alias("fan"))
        if above is not None:
            # below a circle the size is not known, but pointers end there
            sizes = sizes.union(above.select("up", F.col("up_salts"), F.greatest(spread(F.col("subtree_size")), F.col("up_salts"))))
        fans = copies(sizes, F.col("salts")).select("up", "at", "fan")
        state = state.join(fans, ["up", "at"], "left").withColumn("at", F.pmod(F.xxhash64("key"), F.coalesce("fan", F.lit(1))).cast("int"))
        steps = 1
        while steps < run:
            far = copies(state.select(F.col("key").alias("up"), F.col("up").alias("_up"), F.col("top").alias("_top"), F.col("n").alias("_n"), F.col("fan").alias("_fan"), *[F.col("tail").alias("_tail")] * paths, spread(F.col("size")).alias("_here")), F.col("_here"))
            went = F.col("_top").isNotNull()
            state = state.join(far, ["up", "at"], "left").select(
                "key", "parent", "salts", "size", "jobs", F.when(went, F.col("_up")).otherwise(F.col("up")).alias("up"), F.coalesce("_top", "top").alias("top"),
                F.when(went, F.col("n") + 1 + F.col("_n")).otherwise(F.col("n")).alias("n"), F.when(went, F.col("_fan")).otherwise(F.col("fan")).alias("fan"), *[F.when(went, F.concat("_tail", "tail")).otherwise(F.col("tail")).alias("tail")] * paths,
            ).withColumn("at", F.pmod(F.xxhash64("key"), F.coalesce("fan", F.lit(1))).cast("int"))
            steps *= 2
        fan = F.greatest(spread(F.col("subtree_size")), F.col("up_salts"))
    if above is None:
        state = state.withColumns({"up_root": F.lit(None).cast("string"), "up_depth": F.lit(None).cast("int")} | ({"up_path": F.lit(None).cast("array<string>")} if paths else {}))
    else:
        state = state.join(copies(above.withColumn("_fan", fan), F.col("_fan")).drop("_fan", "subtree_size", "up_salts"), ["up", "at"], "left")
    inside = F.col("up_depth").isNull()
    depth = F.when(inside, F.col("n")).when(F.col("up_depth") < 0, F.col("up_depth")).otherwise(F.col("up_depth") + 1 + F.col("n"))
    path = [F.when(inside, F.col("tail")).when(F.col("up_depth") >= 0, F.concat("up_path", "tail")).alias("path")] * paths
    return state.select(F.col("key").alias("node_key"), F.col("parent").alias("parent_key"), F.when(inside, F.col("top")).otherwise(F.col("up_root")).alias("root_key"), depth.alias("depth"), F.col("size").alias("subtree_size"), F.lit(False).alias("on_cycle"), "salts", *path, "jobs")


def descendants(resolved: DataFrame) -> DataFrame:
    """(ancestor_key, descendant_key, distance) for every pair on one path, from ``resolve_hierarchy``.

    Rows, not lists, so an ancestor with a third of all nodes below it is no large
    group. Nodes on or below a circle have no path and so no row.
    """
    at = resolved.select("node_key", "depth", F.posexplode("path").alias("pos", "ancestor_key"))
    return at.filter(F.col("pos") < F.col("depth")).select("ancestor_key", F.col("node_key").alias("descendant_key"), (F.col("depth") - F.col("pos")).alias("distance"))
