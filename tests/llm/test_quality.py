import functools
import random

import pytest

from quireflow.llm import quality as Q

PROSE = "The reader may treat the mean in the same way. It is enough to test the sum of the first terms, and the answer follows from this.\n这个方法在学习中十分常见，我们把它留作课后思考。"
FORMS = {
    "list": "Some items of the course follow here.\n" + "\n".join(f"- item {w}" for w in "alpha beta gamma delta omega sigma kappa".split()),
    "table": "\n".join(f"row {i}\t{i * 7}\t{i % 3}" for i in range(9)),
    "junk": "click here " * 40,
}


def test_forms():
    for form, t in FORMS.items():
        assert Q.finish(Q.partials([t])[0])["form"] == form
    for t in (PROSE, PROSE.replace(" ", "\n", 7), "1. " + PROSE):
        assert Q.finish(Q.partials([t])[0])["form"] == "prose"


def test_chunks_in_any_bracketing_give_the_whole():
    rng = random.Random(3)
    for t in [*FORMS.values(), PROSE * 3, "word", " a b. c", "\n\n", "字。\nxyz abc.\n\n1,2,3,4\n"]:
        whole = Q.finish(Q.partials([t])[0])
        for _ in range(8):
            cuts = sorted(rng.sample(range(len(t) + 1), min(4, len(t))))
            parts = Q.partials([p for p in (t[i:j] for i, j in zip([0, *cuts], [*cuts, len(t)])) if p])
            left = Q.finish(functools.reduce(Q.merge, parts))
            right = Q.finish(functools.reduce(lambda b, a: Q.merge(a, b), reversed(parts)))
            for got in (left, right):
                assert got == whole


def test_operator_with_huge_and_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(Q, "CHUNK", 50)
    monkeypatch.setattr(Q, "FAN_IN", 2)
    monkeypatch.setattr(Q, "LEVELS", 6)
    data = [(1, PROSE * 4, "x"), (2, None, "x"), (3, "", "x"), (4, " \n ", "x"), (5, FORMS["table"], "x"), (5, FORMS["table"], "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, form string")
    got = Q.text_statistics(df).orderBy("doc_id").collect()
    assert [(r.doc_id, r.form) for r in got] == [(1, "prose"), (3, "prose"), (4, "junk"), (5, "table"), (5, "table")]
    whole = Q.finish(Q.partials([PROSE * 4])[0])
    assert (got[0].n_chars, got[0].n_words, got[0].n_lines) == (whole["n_chars"], whole["n_words"], whole["n_lines"])
    assert Q.not_prose(df.limit(0)).count() == 0


LANGUAGES = {
    "ru": "Сначала запишем условие задачи в виде уравнения. Затем подставим значение и получим ответ, который удовлетворяет всем условиям. Проверка показывает, что других решений нет.",
    "de": "Zuerst schreiben wir die Bedingung als Gleichung auf. Danach setzen wir den Wert ein und erhalten das Ergebnis, das alle Bedingungen erfüllt.",
    "fr": "Nous écrivons d'abord la condition sous la forme d'une équation. Ensuite nous vérifions que la valeur trouvée répond à toutes les conditions.",
    "pl": "Najpierw zapisujemy warunek zadania w postaci równania. Następnie podstawiamy wartość i otrzymujemy wynik, który spełnia wszystkie warunki.",
    "ja": "まず条件を式で表します。次に値を代入して、すべての条件を満たすことを確かめます。ほかの解はありません。",
    "ko": "먼저 조건을 방정식으로 적습니다. 그리고 값을 대입하여 모든 조건을 만족하는지 확인합니다. 다른 해는 없습니다.",
    "ar": "نكتب أولا شرط المسألة على شكل معادلة. ثم نعوض القيمة ونحصل على الجواب الذي يحقق جميع الشروط.",
    "el": "Πρώτα γράφουμε τη συνθήκη ως εξίσωση. Έπειτα αντικαθιστούμε την τιμή και παίρνουμε το αποτέλεσμα που ικανοποιεί όλες τις συνθήκες.",
    "hi": "पहले हम शर्त को समीकरण के रूप में लिखते हैं। फिर मान रखकर उत्तर प्राप्त करते हैं जो सभी शर्तों को पूरा करता है।",
}


@pytest.mark.parametrize("lang", LANGUAGES)
def test_prose_of_any_language_is_prose(lang):
    for t in (LANGUAGES[lang], LANGUAGES[lang] * 3):
        assert Q.finish(Q.partials([t])[0])["form"] == "prose"


def test_repeats_of_long_texts():
    rng = random.Random(1)
    once = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(36_000))
    for n in (1, 2, 4):
        got = Q.finish(Q.partials([once * n])[0])["repeat_share"]
        assert abs(got - (1 - 1 / n)) < 0.06


def test_letters_and_digits_at_random_are_junk():
    rng = random.Random(2)
    t = "".join(rng.choice("ABCDEIOUabcdeiou0123456789+/") for _ in range(400))
    assert Q.finish(Q.partials([t])[0])["form"] == "junk"
