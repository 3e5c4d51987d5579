import itertools
import random

from quireflow.llm import grouping as G


def frame(spark, data):
    return spark.createDataFrame(data, "left_ref string, right_ref string, action string, u string, n int")


def brute(pairs):
    group = {}
    for a, b in pairs:
        one = group.get(a, {a}) | group.get(b, {b})
        for x in one:
            group[x] = one
    return sorted((x, min(g)) for x, g in group.items())


def test_spelling_nulls_and_self_links(spark, get):
    data = [("b", "a", " Merge　", "z", 1), ("b", "c", "MERGE", "z", 1), ("c", "b", "merge", "z", 1), ("x", "y", "keep", "z", 1), ("x", "x", "merge", "z", 1), (None, "a", "merge", "z", 1), ("q", "", "merge", "z", 1), ("p", "o", None, "z", 1), ("d", "e", "merged", "z", 1)]
    assert get(G.merge_groups(frame(spark, data))) == [("a", "a"), ("b", "a"), ("c", "a")]
    assert G.merge_groups(frame(spark, [])).count() == 0


def test_chain_star_and_random_against_brute_force(spark, get):
    rng = random.Random(8)
    order = [f"c{i:03}" for i in range(30)]
    rng.shuffle(order)
    pairs = list(itertools.pairwise(order)) + [("hub", f"s{i:02}") for i in range(40)] + [(f"r{rng.randrange(60)}", f"r{rng.randrange(60)}") for _ in range(45)]
    data = [(a, b, "merge", "x", 0) for a, b in pairs]
    assert get(G.merge_groups(frame(spark, data), hot_rows=5)) == brute([p for p in pairs if p[0] != p[1]])
