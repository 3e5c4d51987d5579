"""Queries on small tables of their own, for rows that the test tables don't have."""

import itertools

from quireflow.plans.catalog import QUERIES


def save(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_labels_of_one_set_of_character_pairs(spark, get, tmp_path):
    labels = {"abab": ["k1", "k7"], "ababab": ["k2"], "baba": ["k3", "k8"], "abcdefghij": ["k4"], "abcdefghijk": ["k5"], "xy": ["k6"], "abcdefghijkabcd": ["k9"]}
    save(spark, tmp_path, "concepts", [(k, label) for label, ks in labels.items() for k in ks] + [("k0", None), ("k1", "abab")], "concept_key string, preferred_label string")
    grams = {label: {label[i : i + 2] for i in range(len(label) - 1)} for label in labels}
    links = {}
    for a, b in itertools.combinations(labels, 2):
        s = len(grams[a] & grams[b]) / len(grams[a] | grams[b])
        if s >= 0.8:
            links[tuple(sorted((min(labels[a]), min(labels[b]))))] = round(s, 6)
    assert get(QUERIES["label_jaccard"](spark, str(tmp_path))) == sorted((*k, s) for k, s in links.items())
    assert [k for k, s in links.items() if s == 1] == [("k1", "k2"), ("k1", "k3"), ("k2", "k3")]
    members = []
    for label, ks in labels.items():
        least = min(ks)
        members += [(k, least, min(x for y in labels if grams[y] == grams[label] for x in labels[y]), sum(least in pair for pair in links)) for k in ks]
    assert get(QUERIES["label_members"](spark, str(tmp_path))) == sorted(members)


def test_item_inside_a_long_question(spark, get, tmp_path):
    item, other = "求函数f(x)=3x+8在区间[2,9]上的最大值与最小值之和", "袋中装有五个红色竹篮和七个白色竹篮，任意摸出两个，求颜色相同的概率是多少"
    long = "".join(chr(0x4E00 + 7 * i) for i in range(200))
    short = other[:14]
    save(spark, tmp_path, "eval_items", [("i1", item), ("i2", other), ("i1", item), ("i3", None)], "item_id string, item_text string")
    save(spark, tmp_path, "questions", [("q1", long[:100] + item + long[100:]), ("q2", short), ("q3", other[:24] + long), ("q4", None)], "question_id string, question_body string")
    n, part = len(item) - 11, (24 - 11) / (len(other) - 11)
    assert part >= 0.5
    assert get(QUERIES["item_containment"](spark, str(tmp_path))) == [("q1", "i1", n, 1.0), ("q3", "i2", 13, round(part, 6))]


def test_digests_of_sources(spark, tmp_path):
    rows = [(1, "s", "x"), (2, "s", "y"), (3, "t", None), (4, None, "z")]
    changed = {"same": rows[::-1], "text": [(1, "s", "x"), (2, "s", "Y"), *rows[2:]], "null": [*rows[:2], (3, "t", ""), rows[3]]}
    digests = {}
    for name, of in {"first": rows, **changed}.items():
        save(spark, tmp_path / name, "documents", of, "doc_id long, source string, text string")
        digests[name] = {r.source: (r.rows, r.digest) for r in QUERIES["source_digests"](spark, str(tmp_path / name)).collect()}
    first = digests["first"]
    assert {k: n for k, (n, _) in first.items()} == {"s": 2, "t": 1, None: 1} and digests["same"] == first
    differ = {name: {k for k in first if digests[name][k] != first[k]} for name in ("text", "null")}
    assert differ == {"text": {"s"}, "null": {"t"}}


def test_long_sections_and_chinese_numerals(spark, get, tmp_path):
    save(spark, tmp_path, "split_nodes", [("b", "whole", 1, 5000), ("b", "part", 900, 1300), ("b", "odd", 30, 20)], "book_key string, key string, start_line long, end_line long")
    save(spark, tmp_path, "concepts", [("c1", "b", 25), ("c2", "b", 1000), ("c3", "b", 5001), ("c4", "x", 3)], "concept_key string, book_key string, first_source_order long")
    assert get(QUERIES["range_cover"](spark, str(tmp_path))) == [("c1", 1), ("c2", 2), ("c3", 0), ("c4", 0)]
    save(spark, tmp_path, "questions", [("q1", "十二、"), ("q2", "３."), ("q3", None), ("q4", "第三题")], "question_id string, number string")
    assert get(QUERIES["question_numbers"](spark, str(tmp_path))) == [("q1", 12), ("q2", 3), ("q3", None), ("q4", 3)]


def test_items_of_a_small_file_are_not_broadcast(spark, get, tmp_path):
    text = "".join(chr(0x4E00 + i % 5000) for i in range(1500))
    save(spark, tmp_path, "eval_items", [(f"i{k}", text[k:]) for k in range(10)], "item_id string, item_text string")
    save(spark, tmp_path, "questions", [("q1", text[:1011]), ("q2", text[:500])], "question_id string, question_body string")
    found = QUERIES["item_containment"](spark, str(tmp_path))
    # the file is far below the limit for broadcasts, its sequences are far above
    assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()
    assert get(found) == [("q1", f"i{k}", 1000 - k, round((1000 - k) / (1489 - k), 6)) for k in range(10)]
