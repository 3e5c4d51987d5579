import random

import pytest

from quireflow.operators.hierarchy import descendants, resolve_hierarchy

SCHEMA = "key string, parent_key string, root_key string, salt int"


def brute(pairs):
    parent = {}
    for k, p in pairs:
        if k is not None:
            parent.setdefault(k, []).append(p or None)
    parent = {k: min((p for p in ps if p), default=None) for k, ps in parent.items()}
    out = {}
    for k in parent:
        path = [k]
        while True:
            p = parent[path[-1]]
            if p not in parent:
                out[k] = (path[-1], len(path) - 1, path[::-1])
                break
            if p in path:
                out[k] = (min(path[path.index(p) :]), -1, None)
                break
            path.append(p)
    return out


def frame(spark, pairs):
    return spark.createDataFrame([(k, p, "x", 9) for k, p in pairs], SCHEMA)


CASES = {
    "forest": [("a", None), ("b", "a"), ("c", "a"), ("d", "b"), ("e", ""), ("f", "gone")],
    "ring": [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("y", "x"), ("s", "s"), ("t", "s")],
    "chain": [(f"n{i:03}", f"n{i - 1:03}" if i else None) for i in range(7)],
    "nulls and repeats": [(None, "a"), ("a", None), ("a", None), ("b", "a"), ("b", "a"), ("b", "c"), ("c", None)],
}


@pytest.mark.parametrize("name", CASES)
def test_resolve(spark, name):
    got = {r.node_key: (r.root_key, r.depth, r.path) for r in resolve_hierarchy(frame(spark, CASES[name])).collect()}
    assert got == brute(CASES[name])


def test_empty_table(spark):
    assert resolve_hierarchy(frame(spark, [])).count() == 0


def test_hot_parent_is_spread(spark):
    pairs = [("r", None)] + [(f"c{i:04}", "r") for i in range(60)] + [(f"d{i:04}", f"c{i:04}") for i in range(9)]
    got = resolve_hierarchy(frame(spark, pairs), hot_rows=20)
    assert {r.node_key: (r.root_key, r.depth, r.path) for r in got.collect()} == brute(pairs)
    assert got.filter("node_key = 'r'").first().subtree_size == 70


def test_random_forest_with_circles(spark):
    rng = random.Random(3)
    pairs = [(f"k{i}", rng.choice([None, "", "zz", *(f"k{rng.randrange(40)}" for _ in range(9))])) for i in range(40)]
    got = {r.node_key: (r.root_key, r.depth) for r in resolve_hierarchy(frame(spark, pairs), paths=False).collect()}
    assert got == {k: v[:2] for k, v in brute(pairs).items()}


def test_descendants_and_sizes(spark, get):
    resolved = resolve_hierarchy(frame(spark, CASES["forest"]))
    assert get(descendants(resolved)) == [("a", "b", 1), ("a", "c", 1), ("a", "d", 2), ("b", "d", 1)]
    assert {r.node_key: r.subtree_size for r in resolved.collect()}["a"] == 4
