import random

import pytest

from quireflow.llm import pairs as P


@pytest.mark.parametrize("text", [None, "", " 　\n", "略。", "N/A", "答案：", "【解析】\n", "​", "…", "TBD", "Answer:", "见上"])
def test_empty(text):
    assert P.is_empty(text)


@pytest.mark.parametrize("text", ["B", "58", "空集", "$x=2$", "无解", "答案：7", "∅"])
def test_not_empty(text):
    assert not P.is_empty(text)


@pytest.mark.parametrize("text", ["抱歉，我无法回答这个问题，请换一个问题。", "此题不予解答。", "恕难从命，请自行思考。", "This request was declined by the assistant.", "I'm sorry, but I cannot help with this request. Thank you."])
def test_refusal(text):
    assert P.is_refusal(text)


@pytest.mark.parametrize("text", ["方程在实数范围内无解，因此答案是空集。", "由于缺少正切值，本题的存在性无法确定，应当分情况说明。", "The mean cannot increase.", "解：$x=2$，所以不能取负值。"])
def test_no_refusal(text):
    assert not P.is_refusal(text)


def test_copies():
    q = "已知等差数列的首项为80，公差为21，求第43项以及前43项的和。"
    assert P.is_copied(q, q + "\n请作答。") and P.is_copied(q, "解：" + q[: int(len(q) * 0.8)])
    assert not P.is_copied(q, q + "\n解：由通项公式得第43项为962，再由求和公式，前43项的和为22403。")
    assert not P.is_copied(q, "962; 22403")


def test_copies_of_look_alike_letters():
    q = "For the unit \u03bfn geometric series, we may let p be equal to 15, Cadmor draws 58 auxiliary lines, and a second sketch makes it plain. The function f(x)=29x+76 gives the output of candles at the school garden \u03bfn day x. \u03a4he value \u03bff f(7) is\nA. 356\nB. 203\nC. 308\nD. 279"
    r = q.replace("\u03bf", "o").replace("\u03a4", "T") + "\nPlease answer."
    assert P.is_copied(q, r) and P.is_copied(r, q)


def test_copies_with_few_whole_sequences():
    q = "求圆周长三七与直径之比的值"
    assert len(q) == 13 and P.is_copied(q, "下面这里是我的题目" + q)
    long = "".join(chr(0x4E00 + i) for i in range(105))
    altered = "".join(c if i % 7 else "x" for i, c in enumerate(long))
    assert P.is_copied(long, altered)
    assert P.is_copied("计算三百五十二加上一百零六" * 3, "计算三百五十二加上一百零六")


QUESTION = {"zh": "袋中装有%d个红色竹篮和%d个白色竹篮，求摸到红色的概率。", "en": "A bag holds %d red and %d white baskets. Find the probability of the red ones."}
SOLUTION = {"zh": "解：每一个被摸到的可能性相同，所以概率为$\\frac{%d}{%d}$。", "en": "Each piece is equally likely. The probability of red is $\\frac{%d}{%d}$."}


def test_operator(spark, get):
    rows = [(f"{k}{i}", QUESTION[k] % (i, i + 3), SOLUTION[k] % (i, 2 * i + 3), k, "x") for k in ("zh", "en") for i in range(1, 41)]
    odd = [
        ("e1", QUESTION["zh"] % (1, 2), None, "zh", "x"), ("l1", QUESTION["zh"] % (1, 2), SOLUTION["en"] % (1, 3), "zh", "x"),
        ("l2", QUESTION["en"] % (1, 2), "Zuerst schreiben wir die Bedingung als Gleichung. Danach setzen wir den Wert 43 in die Gleichung ein.", "en", "x"),
        ("t1", QUESTION["zh"] % (1, 2), "解：每一个被摸到的可能性相同，所以概", "zh", "x"), ("t2", QUESTION["en"] % (1, 2), "Each piece is equally likely. The probability of red is $\\frac{1", "en", "x"),
        ("ok1", QUESTION["zh"] % (1, 2), "58", None, "x"), ("ok2", None, SOLUTION["zh"] % (1, 3), "zh", "x"), ("e1", QUESTION["zh"] % (1, 2), None, "zh", "x"),
        ("c1", QUESTION["en"] % (5, 6), QUESTION["en"] % (5, 6), "EN ", "x"), (None, "q", None, "zh", "x"),
    ]
    df = spark.createDataFrame(rows + odd, "question_id string, question_body string, solution_body string, lang string, defect string")
    assert get(P.pair_defects(df)) == [("c1", "copied"), ("e1", "empty"), ("l1", "language"), ("l2", "language"), ("t1", "truncated"), ("t2", "truncated")]
    assert P.pair_defects(df.limit(0)).count() == 0


def test_small_languages_and_strange_alphabets():
    from collections import Counter

    ru = "Найдите сумму членов последовательности, если первый член равен числу, а разность постоянна. "
    model = P.LanguageModel({"en": P.grams(QUESTION["en"] % (1, 2) * 300), "zh": P.grams(QUESTION["zh"] % (1, 2) * 300), "ru": P.grams(ru), "xx": Counter({" q": 1})})
    assert not P._other_language(model, ru, "Сумма членов находится по формуле: число равно значению.")
    assert P._other_language(model, ru, SOLUTION["en"] % (1, 2)) and P._other_language(model, SOLUTION["en"] % (1, 2), "مجموع الحدود يساوي العدد المطلوب")
    assert not P._other_language(model, QUESTION["zh"] % (1, 2), "b²+52b=90") and not P._other_language(model, "", "x") and not P._other_language(model, "计算：1+1", "")
    assert max(model.posteriors("a" * 500 + " the probability of the red piece"), key=model.posteriors("a" * 500 + " the probability of the red piece").get) is not None


def test_planted_truncation(spark):
    """Sound responses cut at any place inside a sentence are found; the cut copies of one response do not make a context an end."""
    r = random.Random(4)
    rows, cut = [], set()
    for i in range(600):
        k = r.choice(("zh", "en"))
        whole = SOLUTION[k] % (i % 40, 2 * (i % 40) + 3)
        rows.append((f"w{i}", QUESTION[k] % (i % 40, i % 40 + 3), whole, k))
        if i % 10 == 0:
            at = r.randrange(8, len(whole) - 3)
            for c in "ab":
                rows.append((f"c{i}{c}", QUESTION[k] % (i % 40, i % 40 + 3), whole[:at], k))
                cut.add(f"c{i}{c}")
    df = spark.createDataFrame(rows, "question_id string, question_body string, solution_body string, lang string")
    got = {r.question_id for r in P.pair_defects(df).filter("defect = 'truncated'").collect()}
    ends = {i for i, _, t, _ in rows if i in cut and P.SENTENCE_END.search(t)}
    assert got <= cut and len(got) >= 0.97 * len(cut - ends)
