from pyspark.sql import Row

from quireflow.llm import lookalikes as L


def speller(*texts):
    return L.TokenSpeller(dict(L.count_bigrams(iter(texts))))


def test_widths_blanks_and_ignorables():
    s = speller("the text of the book")
    assert s.text("ｔｈｅ b​o­ok １２，ﬁ㎜ ⽅程⻓") == "the book 12,fi mm 方程长".replace("fi mm", "fimm")


def test_what_reads_differently_stays_apart():
    s = speller("x plain text")
    for a, b in (("x²", "x2"), ("①", "1"), ("é", "e"), ("x̄", "x"), ("Ab", "ab"), ("m²", "m2"), ("½", "1/2")):
        assert s.text(a) != s.text(b)
    assert s.text("㎡") == "m²" and s.text("é") == s.text("é")


def test_look_alike_letters_have_one_spelling():
    s = speller("the scope of a cop", "что это за сосна и вот она")
    assert s.text("sсоре") == s.text("scope") == "scope"
    assert s.text("f(х)") == s.text("f(x)")
    # one lattice has one spelling, whichever script it was typed in
    assert s.text("сор") == s.text("cop")
    assert s.text("х̄") == s.text("x̄") == "x̄"
    assert s.text("что") == "что"


def test_pairs(spark, get):
    long = "длинный " * 20_000
    data = [
        ("b", "1", "q1", "abc"), ("b", "1", "q2", "ａbc"), ("b", "1", "q2", "ａbc"), ("b", "1", "q3", "abc"), ("b", "1", "q4", "abd"), ("b", "2", "q5", "аbc"),
        ("b", "1", "q6", None), ("b", "1", "q7", ""), ("b", "1", "q8", "​"), ("b", None, "q9", "abc"), ("b", "1", "qa", long), ("b", "1", "qb", long + "​"), (None, "1", "x", "abc"),
    ]
    df = spark.createDataFrame(data, "field string, scope string, id string, text string").withColumnRenamed("field", "field")
    assert get(L.same_looking_pairs(df, block=1)) == [("b", "q1", "q2"), ("b", "q2", "q3"), ("b", "q7", "q8"), ("b", "qa", "qb")]
    assert get(L.same_looking_pairs(df)) == get(L.same_looking_pairs(df, block=1))


def test_empty_table_and_columns(spark):
    empty = spark.createDataFrame([], "field string, scope string, id string, text string")
    assert L.same_looking_pairs(empty).count() == 0
    out = L.normalize_texts(spark.createDataFrame([Row(a=1, consistent="x", text=None), Row(a=2, consistent="y", text="ａ")]), "text")
    assert sorted((r.a, r.consistent or "") for r in out.collect()) == [(1, ""), (2, "a")]


def test_classes_hold_the_pairs(spark, get):
    data = [("b", "1", f"q{i:02}", "ａbc" if i % 3 else "abc") for i in range(20)] + [("b", "1", "z", "abd"), ("b", "2", "y", "abc"), (None, "1", "x", "abc"), ("b", "1", "q00", "abc")]
    df = spark.createDataFrame(data, "field string, scope string, id string, text string")
    got = get(L.same_looking_classes(df, hot_rows=4))
    assert got == sorted([("b", f"q{i:02}", "q00", 20, 2) for i in range(20)] + [("b", "z", "z", 1, 1), ("b", "y", "y", 1, 1)], key=repr)
    assert L.same_looking_classes(df.limit(0)).count() == 0


def test_letters_drawn_alike():
    s = speller("a Query with very Good Words")
    for a, b in (("Ԛuery", "Query"), ("Ԍood", "Good"), ("Ԝords", "Words"), ("νery", "very"), ("ѵery", "very")):
        assert s.text(a) == s.text(b) == b
