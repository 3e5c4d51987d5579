import os
import random

import pytest

from quireflow.llm import mixing as M

pytestmark = pytest.mark.skipif(not os.path.exists(f"{M.TOKENIZERS}/{M.VOCABULARY}"), reason="needs the public vocabulary")


def test_shares_caps_and_copies(spark):
    docs = [(i, "one two three four five " * (1 + i % 7), " Big" if i % 2 else "BIG") for i in range(400)] + [(1000 + i, "small text here " * (1 + i % 5), "small one") for i in range(40)] + [(2000, None, "big"), (2001, "", "big"), (2002, "text", None), (2003, "text", "other")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    t = spark.createDataFrame([("big", 0.6, 1), ("small_one", 0.3, 3), ("none", 0.1, 2), ("small_one", 0.3, 3), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    chosen, report = M.mix_sources(df, t)
    shares = {r.source: r.actual_share for r in report.collect()}
    assert abs(shares["big"] - 2 / 3) < 0.01 and abs(shares["small_one"] - 1 / 3) < 0.01 and shares["none"] == 0
    most = {r.source: r.most_copies for r in report.collect()}
    assert most["big"] == 1 and most["small_one"] == 3
    assert chosen.groupBy("key" if "key" in chosen.columns else "doc_id").count().filter("count > 1").count() == 0


def test_tokens_of_nulls_and_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<|endoftext|> a")], "id int, text string")
    got = {r.id: r.tokens for r in M.count_tokens(df).collect()}
    assert got[1] is None and got[2] == 0 and got[3] > 3


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    t = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    chosen, report = M.mix_sources(df, t)
    assert chosen.count() == 0 and report.first().mixed_tokens == 0
    assert M.mix_sources(df, t.limit(0))[1].count() == 0


def test_documents_of_any_length_are_used_alike_and_goals_met_to_a_document(spark):
    rng = random.Random(2)
    sizes = [int(20 * rng.lognormvariate(0, 1)) + 1 for _ in range(3000)]
    docs = [(i, "word " * n, "a" if i % 3 else "b") for i, n in enumerate(sizes)] + [(9000 + i, "word " * 300, "few") for i in range(9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.44, 1), ("few", 0.06, 2)], "source string, target_share double, max_repeats int")
    chosen, report = M.mix_sources(df, t)
    assert all(abs(r.mixed_tokens - r.goal_tokens) <= 310 for r in report.collect())
    tokens = {r.source: (r.t, r.n) for r in chosen.groupBy("source").agg(M.F.sum("tokens").alias("t"), M.F.count("tokens").alias("n")).collect()}
    all_of = {r.source: r.m for r in M.count_tokens(df).groupBy("source").agg(M.F.avg("tokens").alias("m")).collect()}
    assert all(abs(t / n / all_of[s] - 1) < 0.05 for s, (t, n) in tokens.items() if s != "few")
    assert sorted(map(tuple, M.mix_sources(df.repartition(7), t)[0].collect())) == sorted(map(tuple, chosen.collect()))


def test_margin_is_balanced_with_the_sources():
    cells = {("a", "x"): 600.0, ("a", "y"): 400.0, ("b", "x"): 900.0, ("b", "y"): 100.0}
    rates = M.balance(cells, {"a": 500.0, "b": 500.0}, {"a": 1, "b": 1}, {"x": 0.6, "y": 0.4})
    got = {k: rates[k] * n for k, n in cells.items()}
    assert abs(got["a", "x"] + got["a", "y"] - 500) < 1e-3 and abs(got["b", "x"] + got["b", "y"] - 500) < 1e-3
    assert abs(got["a", "x"] + got["b", "x"] - 600) < 1 and all(0 < r < 1 for r in rates.values())
    # the odds are tilted by one factor for each source and one for the value
    odds = {k: r / (1 - r) for k, r in rates.items()}
    assert abs(odds["a", "x"] / odds["a", "y"] - odds["b", "x"] / odds["b", "y"]) < 1e-6
    # what cannot be met is met as far as possible
    out = M.balance({("a", "x"): 10.0}, {"a": 5.0}, {"a": 1}, {"x": 0.5, "y": 0.5})
    assert abs(out["a", "x"] - 0.5) < 1e-6


def test_goals_are_reached_by_the_balance_alone(monkeypatch):
    from quireflow.llm import mixing

    cells = {("a", None): 9000.0, ("b", None): 4000.0, ("c", None): 700.0, ("d", None): 300.0}
    caps, share = {"a": 1, "b": 2, "c": 3, "d": 4}, {"a": 0.5, "b": 0.2, "c": 0.2, "d": 0.1}
    total, goals = mixing.solve_total({s: t * caps[s] for (s, _), t in cells.items()}, share)
    reached = lambda: {s: r * cells[s, v] for (s, v), r in mixing.balance(cells, goals, caps).items()}
    assert all(abs(t - goals[s]) <= 1e-8 * total for s, t in reached().items())
    monkeypatch.setattr(mixing, "MAX_STEPS", 0)
    missed = [s for s, t in reached().items() if abs(t - goals[s]) > 0.01 * total]
    assert len(missed) >= 3
