import itertools
import random

from pyspark.sql import functions as F

from quireflow.functions import text as T
from quireflow.operators import audits, geometry, graph, linkage, rules, sequences, similarity, state
from quireflow.operators.skew import lookup_join


def test_first_match_takes_the_first_rule(spark):
    df = spark.createDataFrame([("ab",), ("b",), (None,), ("",)], "t string")
    out = [r[0] for r in df.select(rules.first_match("t", [("a", "A"), ("b", "B")], "other")).collect()]
    assert out == ["A", "B", "other", "other"]


def test_rule_table(spark, get):
    df = spark.createDataFrame([(1, "abc"), (2, "ax"), (3, "q"), (4, None)], "id int, v string")
    r = spark.createDataFrame([("a", 2, "short"), ("ab", 1, "long")], "prefix string, priority int, class string")
    assert get(rules.rule_table_match(df, "v", r, ["id"]).select("id", "class")) == [(1, "long"), (2, "short"), (3, None), (4, None)]


def test_lookup_join_with_hot_key(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("k3", 2)], "k string, v int")
    plain = sorted(map(tuple, left.join(right, "k", "left").select("id", "v").collect()))
    assert sorted(map(tuple, lookup_join(left, right, "k", "id", "left", hot_rows=10).select("id", "v").collect())) == plain


def test_sequences(spark, get):
    df = spark.createDataFrame([("a", n) for n in (1, 2, 2, 4, 7)] + [("b", 5), (None, None)], "c string, n int")
    assert get(sequences.integer_ranges(df, ["c"], "n")) == [("a", 1, 2), ("a", 4, 4), ("a", 7, 7), ("b", 5, 5)]
    assert get(sequences.missing_numbers(df, ["c"], "n")) == [("a", 3), ("a", 5), ("a", 6)]
    ranges = spark.createDataFrame([("x", 1, 3), ("x", 4, 6), ("x", 6, 8), ("x", 11, 10), ("x", 12, 13)], "c string, s int, e int")
    assert get(sequences.tiling_errors(ranges, ["c"], "s", "e")) == [("x", 11, "reversed"), ("x", 12, "gap"), ("x", 6, "overlap")]
    assert get(sequences.uncovered_ranges(ranges, ["c"], "s", "e")) == [("x", 9, 11)]


def test_pack_keeps_oversized_rows_alone(spark, get):
    df = spark.createDataFrame([("a", i, s) for i, s in enumerate([4.0, 4.0, 4.0, 20.0, 1.0])], "c string, i long, s double")
    out = sequences.pack(df, ["c"], "i", "s", 10, "c string, i long, s double, packet int")
    assert [r[3] for r in get(out)] == [1, 1, 2, 3, 4]


def test_global_rank(spark):
    values = [random.Random(1).randrange(50) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int")
    got = [r.i for r in sequences.global_rank(df, [F.col("v"), F.col("i")], "r").orderBy("r").collect()]
    assert got == [i for _, i in sorted((v, i) for i, v in enumerate(values))]


def test_level_ranges(spark, get):
    df = spark.createDataFrame([("b", i + 1, v) for i, v in enumerate([1, 2, 3, 2, 1])], "c string, p long, level int")
    out = sequences.level_ranges(df, ["c"], "p", "level", F.lit(5).cast("long"), range(1, 4))
    assert [r[3] for r in get(out)] == [4, 3, 3, 4, 5]


def test_link_statuses(spark):
    q = spark.createDataFrame([("q1", "a", "1"), ("q2", "b", "2"), ("q3", "c", None), ("q4", "a", "9"), ("q5", "d", "7")], "q string, x string, y string")
    a = spark.createDataFrame([("A", "a", "0"), ("B", "b", "5"), ("C", "z", "2"), ("D", "d", "7"), ("E", "d", "8")], "r string, x string, y string")
    got = {r.q: (r.status, r.strategy, r.r) for r in linkage.link(q, a, "q", "r", [("x", F.col("x"), F.col("x")), ("y", F.col("y"), F.col("y"))]).collect()}
    assert got == {"q1": ("matched", "x", "A"), "q2": ("conflicting-answer", None, None), "q3": ("missing-answer", None, None), "q4": ("duplicate-answer", None, None), "q5": ("duplicate-answer", None, None)}


def test_jaccard_join_against_brute_force(spark):
    rng = random.Random(5)
    sets = {i: sorted(set(rng.choices("abcdefghij", k=rng.randint(0, 7)))) for i in range(60)}
    df = spark.createDataFrame(list(sets.items()), "id int, items array<string>")
    one = {}
    for i, s in sets.items():
        one.setdefault(tuple(s), i)
    expect = set()
    for (a, i), (b, j) in itertools.combinations(one.items(), 2):
        if a and b and len(set(a) & set(b)) / len(set(a) | set(b)) >= 0.6 - 1e-9:
            expect.add((min(i, j), max(i, j)))
    assert {(r.left_id, r.right_id) for r in similarity.jaccard_join(df, "id", "items", 0.6).collect()} == expect


def test_containment_join_against_brute_force(spark):
    rng = random.Random(6)
    left = {i: sorted(set(rng.choices("abcdefghijkl", k=rng.randint(1, 6)))) for i in range(30)}
    right = {i: sorted(set(rng.choices("abcdefghijkl", k=rng.randint(0, 9)))) for i in range(30)}
    got = similarity.containment_join(spark.createDataFrame(list(left.items()), "l int, items array<string>"), spark.createDataFrame(list(right.items()), "r int, items array<string>"), "l", "r", "items", 0.5)
    expect = {(i, j): len(set(a) & set(b)) / len(a) for i, a in left.items() for j, b in right.items() if len(set(a) & set(b)) / len(a) >= 0.5}
    assert {(r.l, r.r): r.containment for r in got.collect()} == expect


def test_graphs(spark, get):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("x", "y"), ("a", "b"), (None, "z")], "src string, dst string")
    assert get(graph.components(e)) == [("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")]
    assert get(graph.cycle_members(e)) == [("a",), ("b",), ("c",)]
    assert get(graph.true_cycle_nodes(e)) == [("b",), ("c",)]
    dag = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("a", "d")], "src string, dst string")
    assert get(graph.redundant_edges(dag)) == [("a", "c"), ("a", "d")]
    assert get(graph.topological_levels(dag)) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


def test_components_of_a_long_chain(spark):
    order = list(range(60))
    random.Random(2).shuffle(order)
    e = spark.createDataFrame([(f"{a:03}", f"{b:03}") for a, b in itertools.pairwise(order)], "src string, dst string")
    got = graph.components(e).collect()
    assert len(got) == 60 and {r.component for r in got} == {"000"}


def test_greedy_cap_against_fold(spark):
    rng = random.Random(9)
    pairs = [(f"p{i:03}", f"n{a}", f"n{b}", rng.choice([0.1, 0.5, 0.9])) for i, (a, b) in enumerate(rng.sample(list(itertools.combinations(range(15), 2)), 70))]
    used, expect = {}, set()
    for i, a, b, _ in sorted(pairs, key=lambda p: (-p[3], p[0])):
        if used.get(a, 0) < 3 and used.get(b, 0) < 3:
            expect.add(i)
            used[a], used[b] = used.get(a, 0) + 1, used.get(b, 0) + 1
    df = spark.createDataFrame(pairs, "id string, left_id string, right_id string, score double")
    assert {r.id for r in graph.greedy_degree_cap(df, 3).collect()} == expect


def test_audits(spark, get):
    a = spark.createDataFrame([(1,), (2,), (2,), (None,)], "v int")
    b = spark.createDataFrame([(2,), (3,)], "v int")
    assert get(audits.set_differences(a, b, "v", ("left", "right"))) == [("left", "1", None), ("right", "3", None)]
    assert get(audits.missing_references(a, "v", b, "v", "lost")) == [("lost", "1", None)]
    assert get(audits.repeated_keys(a.dropna(), ["v"], "twice")) == [("twice", "2", "2")]
    assert audits.profile(a, ["v"]).first().nulls == 1


def test_state(spark, get):
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1")], "k string, h string")
    new = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1")], "k string, h string")
    assert get(state.changes(old, new, "k", "h")) == [("b", "changed"), ("c", "removed"), ("d", "added")]
    known = spark.createDataFrame([("a", 7), ("c", 2)], "k string, n long")
    assert get(state.allocate_ids(known, new.select("k"), "k", "n")) == [("a", 7, False), ("b", 8, True), ("d", 9, True)]
    docs = spark.createDataFrame([("s", "x"), ("s", "y"), ("t", "y"), ("t", "x"), ("u", "x")], "g string, v string").withColumn("h", state.row_digest("v"))
    digests = {r.g: r.digest for r in state.table_digest(docs, ["g"], "h").collect()}
    assert digests["s"] == digests["t"] != digests["u"]
    both = state.upsert(spark.createDataFrame([("a", 1, "old"), ("b", 3, "old")], "k string, v int, t string"), spark.createDataFrame([("a", 2, "new"), ("b", 2, "new"), ("c", 1, "new")], "k string, v int, t string"), ["k"], "v")
    assert get(both.select("k", "t")) == [("a", "new"), ("b", "old"), ("c", "new")]


def test_boxes_against_brute_force(spark):
    rng = random.Random(4)
    boxes = [(i, *(float(rng.randint(0, 80)) for _ in range(2)), *(float(rng.randint(1, 30)) for _ in range(2))) for i in range(60)]
    df = spark.createDataFrame(boxes, "id int, x double, y double, w double, h double")
    over = {(a[0], b[0]) for a, b in itertools.combinations(boxes, 2) if a[1] < b[1] + b[3] and b[1] < a[1] + a[3] and a[2] < b[2] + b[4] and b[2] < a[2] + a[4]}
    assert {tuple(r) for r in geometry.overlapping_boxes(df, "id", 16.0).collect()} == over
    inside = {(a[0], b[0]) for a, b in itertools.permutations(boxes, 2) if a[1] <= b[1] and a[2] <= b[2] and b[1] + b[3] <= a[1] + a[3] and b[2] + b[4] <= a[2] + a[4]}
    assert {tuple(r) for r in geometry.contained_boxes(df, "id", 16.0).collect()} == inside


def test_text_functions(spark):
    df = spark.createDataFrame([("十二、", "abc", [1.0, 0.0], [0.0, 0.0])], "n string, t string, u array<double>, v array<double>")
    r = df.select(
        T.question_number("n").alias("n"), T.ngrams("t", 2).alias("g"), T.ngrams(F.lit(""), 2).alias("e"), T.cosine("u", "v").alias("c"), T.cosine("u", "u").alias("one"),
        T.containment(F.array().cast("array<string>"), F.array().cast("array<string>")).alias("empty"), T.sanitize_file_name(F.lit("con.txt")).alias("f"), T.strip_html(F.lit("<p>a&lt;b</p>")).alias("h"),
        T.link_targets(F.lit("[a](b.md) ![c](d.png) [e](http://x) [f](#g)")).alias("l"), T.embed_targets(F.lit("![[x|y]] ![[z#h]]")).alias("m"), T.star_level(F.lit("★★☆")).alias("s"),
    ).first()
    assert (r.n, r.g, r.e, r.c, r.empty, r.f, r.l, r.m, r.s) == (12, ["ab", "bc"], [], 0.0, 1.0, "_con.txt", ["b.md", "d.png"], ["x", "z"], 2.5)
    assert abs(r.one - 1) < 1e-12 and r.h == "a<b\n"


def test_vector_neighbours_skips_odd_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, [1.0]), (6, None)], "id int, v array<float>")
    got = [tuple(r)[:2] for r in similarity.vector_neighbours(df, df, "id", "v", 1).orderBy("query_id").collect()]
    assert got == [(1, 2), (2, 1), (3, 2)]


def test_chains_and_reusable_stages(spark, get):
    c = spark.createDataFrame([("a", 1, "x", "y"), ("a", 2, "y", "z"), ("a", 3, "w", "v"), ("b", 1, None, "q"), ("b", 2, "q", None), ("b", 3, None, "r")], "k string, n int, before string, after string")
    assert get(state.chain_breaks(c, ["k"], ["n"], "before", "after")) == [("a", 3)]
    s = spark.createDataFrame([("p", 1, "completed", "f1"), ("p", 2, "failed", "f1"), ("q", 1, "completed", "f2")], "k string, n int, status string, f string")
    w = spark.createDataFrame([("p", "f1"), ("q", "f2"), ("r", "f3")], "k string, f string")
    assert get(state.current(s, "k", ["n"], "status", "f", w)) == [("p", False), ("q", True), ("r", False)]


def test_records_sections_and_links_with_hot_keys(spark, get):
    from quireflow.operators import linkage, records, skew
    from quireflow.operators import similarity as sim

    lines = spark.createDataFrame([("d", 1, "intro"), ("d", 2, "1. a"), ("d", 3, "b"), ("d", 4, "2. c"), ("e", 1, None)], "doc string, line int, text string")
    cut = records.segment(lines, ["doc"], "line", F.col("text").rlike(r"^\d+\."))
    assert get(records.bodies(cut.filter("record > 0"), ["doc", "record"], "line", "text")) == [("d", 1, 2, 3, "1. a\nb"), ("d", 2, 4, 4, "2. c")]
    assert get(records.inherit(lines, ["doc"], "line", F.when(F.col("text").rlike("^[0-9]"), F.col("text")), "head").select("doc", "line", "head").filter("head is not null")) == [("d", 2, "1. a"), ("d", 3, "1. a"), ("d", 4, "2. c")]
    # a key of half the rows, spread, gives what a plain join gives
    left = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i}") for i in range(60)] + [(99, None)], "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k4", 3), (None, 4)], "k string, v int")
    for how in ("inner", "left"):
        assert get(skew.lookup_join(left, right, "k", "id", how, hot_rows=5).select("id", "k", "v")) == get(left.join(right, "k", how).select("id", "k", "v"))
    assert skew.hot_side(left, "k", 1000) is None and skew.hot_side(left, "k", 5) is not None
    # an answer that several records decide belongs to the least of them; undecided ones stay apart
    q = spark.createDataFrame([(f"q{i}", "x" if i < 3 else None) for i in range(9)], "q string, v string")
    a = spark.createDataFrame([("a1", "x")], "a string, v string")
    got = get(linkage.link(q, a, "q", "a", [("v", F.col("v"), F.col("v"))]))
    assert got == [("q0", "matched", "v", "a1")] + [(f"q{i}", "duplicate-answer", None, None) for i in (1, 2)] + [(f"q{i}", "missing-answer", None, None) for i in range(3, 9)]
    # neighbours over several batches of one task equal brute force
    import random

    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-3, 4)) for _ in range(4)]) for i in range(120)] + [(500, [1.0]), (501, None), (502, [0.0] * 4)]
    e = spark.createDataFrame(rows, "id int, v array<double>").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = get(sim.vector_neighbours(e.filter("id < 5"), e, "id", "v", 3).select("query_id", "neighbour_id", "rank"))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    norm = lambda v: sum(x * x for x in v) ** 0.5
    want = []
    ok = [(i, v) for i, v in rows if v and len(v) == 4 and norm(v)]
    for i, v in ok[:5]:
        if i < 5:
            best = sorted((-round(sum(a * b for a, b in zip(v, w)) / norm(v) / norm(w), 9), j) for j, w in ok if j != i)[:3]
            want += [(i, j, r) for r, (_, j) in enumerate(best, 1)]
    assert got == sorted(want, key=repr)


def test_pack_passes_rows_in_batches_over_contexts(spark, get):
    rng = random.Random(3)
    rows = [(c, i, rng.choice([None, float("nan"), 1.0, 2.5, 4.0, 12.0])) for c in [None, *range(300)] for i in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, "c int, i int, s double").repartition(7)
    expect, context = [], ()
    for c, i, s in rows:
        n = s if s and s == s else 0.0
        if context != (c,) or held + n > 10:
            packet, held = (packet + 1 if context == (c,) else 1), 0.0
        context, held = (c,), held + n
        expect.append((c, i, packet))
    out = sequences.pack(df, ["c"], "i", "s", 10, "c int, i int, s double, packet int")
    assert get(out.select("c", "i", "packet")) == sorted(expect, key=repr)
    # one Python call for a batch, not one for each context
    assert "FlatMapGroups" not in out._jdf.queryExecution().sparkPlan().toString()
