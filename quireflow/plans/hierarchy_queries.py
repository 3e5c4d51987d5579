"""Queries on the sections of split books as a hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hierarchy import descendants, resolve_hierarchy
from ..sources.tables import table


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    nodes = resolve_hierarchy(table(spark, folder, "split_nodes"), paths=False)
    return nodes.select("node_key", "root_key", "depth")


def p2_hierarchy(spark: SparkSession, folder: str) -> DataFrame:
    """Every section with its path and the number of sections at and below it."""
    nodes = resolve_hierarchy(table(spark, folder, "split_nodes"))
    return nodes.select("node_key", "root_key", "depth", F.concat_ws("/", "path").alias("path"), "subtree_size", "on_cycle")


def p2_descendants(spark: SparkSession, folder: str) -> DataFrame:
    return descendants(resolve_hierarchy(table(spark, folder, "split_nodes")))


QUERIES = {"p2_found": p2_found, "p2_hierarchy": p2_hierarchy, "p2_descendants": p2_descendants}

_TREE = """
with recursive n as (select key, min(nullif(parent_key, '')) as parent from split_nodes where key is not null group by key),
p as (select a.key, b.key as parent from n a left join n b on a.parent = b.key),
down as (
  select key as node_key, key as root_key, 0 as depth, [key] as path from p where parent is null
  union all
  select p.key, d.root_key, d.depth + 1, list_append(d.path, p.key) from p join down d on p.parent = d.node_key),
lost as (select key, parent from p where key not in (select node_key from down)),
up as (select key, parent as above from lost union select u.key, l.parent from up u join lost l on u.above = l.key),
ring as (select key from up where key = above),
circle as (select u.key, min(u.above) as root_key from up u where u.above in (select key from ring) group by u.key)
"""
SQL = {
    "p2_found": _TREE + "select node_key, root_key, depth from down union all select key, root_key, -1 from circle",
    "p2_hierarchy": _TREE
    + """, below as (select key as top, key as node from p union select b.top, p.key from below b join p on p.parent = b.node),
size as (select top, count(*) as n from below group by top)
select node_key, root_key, depth, array_to_string(path, '/') as path, n as subtree_size, false as on_cycle from down join size on top = node_key
union all
select c.key, c.root_key, -1, '', case when c.key in (select key from ring) then null else n end, c.key in (select key from ring) from circle c join size on top = c.key""",
    "p2_descendants": _TREE + "select unnest(path[:-2]) as ancestor_key, node_key as descendant_key, unnest(generate_series(depth, 1, -1))::int as distance from down where depth > 0",
}
