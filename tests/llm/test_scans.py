import random
import time
from collections import Counter

import numpy as np
import pytest

from quireflow.llm import scans as S

ZH = "在学习{t}时，老师建议先估计{w}再动笔，所以{v}的取值不超过{n}。已知等差数列的首项为{n}，公差为{m}，求第{m}项以及前{m}项的和。因为直线的方程未知，每一步都要设大小角度。"
EN = "When we study {t}, the reader may treat the {w} in the same way, and the number {n} of boxes must be checked, which explains the other {m} steps of the calculation."


def texts(n, seed):
    rng = random.Random(seed)
    zh = dict(t=("三角函数", "圆周角", "条件概率", "二次函数"), w=("最大值", "斜率", "中位数"))
    en = dict(t=("normal vectors", "linear models", "conditional probability"), w=("mean", "domain", "radius"))
    out = []
    for _ in range(n):
        form, words = (ZH, zh) if rng.random() < 0.6 else (EN, en)
        out.append(form.format(n=rng.randint(10, 999), m=rng.randint(2, 99), v=rng.choice("abxy"), **{k: rng.choice(v) for k, v in words.items()}))
    return out


@pytest.fixture(scope="module")
def editor():
    return S.train_editor(texts(1500, 1), [])


def test_held_out_misreadings(editor):
    rng = random.Random(4)
    made = [editor.noise.noisy(t, rng, 0.03) for t in texts(300, 2)]
    fixed, noise = editor.edit([t for t, _ in made])
    truth = {i for i, (_, edits) in enumerate(made) if edits}
    assert len(noise["misread"] & truth) >= 0.95 * len(truth) and len(noise["misread"] - truth) <= 3
    kinds = {"delete" if len(e.bad) > len(e.right) else "insert" if len(e.bad) < len(e.right) else "replace" for _, edits in made for _, e in edits}
    assert kinds >= {"delete", "replace"}
    same = sum(a == b for a, b in zip(fixed, texts(300, 2)))
    assert same >= 0.9 * len(fixed)


def test_furniture_cut_words_and_line_breaks(editor):
    zh = texts(40, 3)
    page = next(t for t in zh if t.startswith("在"))
    scan = page[:30] + "\n第三章 圆周角与斜率\n- 205 -\n" + page[30:60] + "\n" + page[60:]
    en = next(t for t in zh if t.startswith("When"))
    cut = en.index("same") + 2
    word = en[:cut] + "¬ \n" + en[cut:]
    wrapped = page[:25] + "\n" + page[25:]
    fixed, noise = editor.edit([scan, word, wrapped, page, "", "391", "所得结果依次为：\n216"])
    assert fixed[0] == page and fixed[1] == en and fixed[2] == page and fixed[3] == page
    assert noise == {"split_word": {1}, "misread": set(), "running_header": {0}, "page_number": {0}}


def test_operator_edge_cases(spark, get, editor):
    long = (texts(1, 5)[0] + "\n") * 3000
    data = [("f", "1", None, 1), ("f", "2", "", 1), ("f", "3", "\n\n", 1), ("f", "4", long, 1), ("f", "5", "\x02퟿​", 1), (None, "6", "第\n12\n页", 1)]
    df = spark.createDataFrame(data, "field string, id string, text string, noise int")
    assert {r.record_id for r in S.scan_noise(df, editor).collect()} <= {"4", "5", "6"}
    assert S.scan_noise(df.limit(0), editor).count() == 0
    out = {r.id: (r.repaired, r.noise) for r in S.repair_texts(df.drop("noise"), editor).collect()}
    assert out["1"] == (None, None) and out["2"] == ("", [])
    # a table without clean texts trains nothing and finds nothing
    assert S.scan_noise(df.filter("id in ('1', '2')")).count() == 0


def test_confusions_of_no_list(get):
    """Confusions that no table holds are learned from the texts alone, and repaired in held-out ones."""
    new = {"时": "吋", "这": "迖", "值": "値", "角": "甪", "项": "顼"}
    assert not set(new) & set(S.MISREAD_CJK) - {"角"} and not set(new.values()) & set(S.MISREAD_CJK.values())
    rng = random.Random(6)
    scan = lambda t: "".join(new[c] if c in new and rng.random() < 0.04 else c for c in t)
    editor = S.train_editor([scan(t) for t in texts(2500, 8)], [])
    assert len(editor.noise.learned) >= 3 and set(editor.noise.learned) <= {(v, k) for k, v in new.items()}
    clean = texts(400, 9)
    held = [scan(t) for t in clean]
    fixed, noise = editor.edit(held)
    known = {k: v for k, v in new.items() if (v, k) in editor.noise.learned}
    truth = {i for i, (a, b) in enumerate(zip(clean, held)) if any(v in b for v in known.values())}
    assert len(noise["misread"] & truth) >= 0.95 * len(truth) and len(noise["misread"] - truth) <= 0.01 * len(held)


def test_sound_text_stays_as_it_was(editor):
    sound = ["сумма чисел равна Α + Β", "Το άθροισμα των γωνιών", "ｔｈｅ　ｓａｍｅ　ｗａｙ １２，（ａ）", "می‌خواهم", "naïve x̄ ﬁn­e", "…", "​"]
    fixed, noise = editor.edit(sound)
    assert fixed == sound and not any(noise.values())
    zh = next(t for t in texts(40, 3) if t.startswith("在"))
    wide = zh.replace("，", "，​")
    assert editor.edit([wide[:20] + "\n" + wide[20:]])[0] == [wide]


def test_insert_and_delete(editor):
    noise = S.NoiseModel()
    assert {e.right for e in noise.edits if e.bad == "m"} == {"rn"} and {e.right for e in noise.edits if e.bad == "`"} == {""}
    t = next(x for x in texts(60, 3) if x.startswith("When"))
    bad = t.replace("reader", "rea`der").replace("treat", "freat")
    fixed, found = editor.edit([bad])
    assert fixed == [t] and found["misread"] == {0}


def test_the_editor_is_trained_on_all_texts(spark):
    """Confusions of texts too long for the former sample are learned, as they are from all texts at once, and repaired."""
    from quireflow.storage import Scratch

    rng, made = random.Random(3), []
    for t in texts(3000, 21):
        made.append("".join("狠" if c == "项" and rng.random() < 0.03 else c for c in t))
    long = [" ".join(made[i : i + 600]) for i in range(0, 3000, 600)]
    assert min(map(len, long)) > 20_000
    df = spark.createDataFrame([("f", str(i), t) for i, t in enumerate(long)], "field string, id string, text string")
    learned, bitmap = S.confusions_of(df, Scratch(spark, "test"))
    expect, usual = S.learn_confusions(long)
    assert ("狠", "项") in learned and learned == expect
    of = usual[1] == ord("项")
    assert of.any() and S._marked_context(usual[0][of], usual[1][of], bitmap).all()
    editor = S.train_on_all(df)
    fixed, noise = editor.edit(["已知等差数列的首项为35，公差为8，求第8狠以及前8项的和。"])
    assert noise["misread"] == {0} and "狠" not in fixed[0]


def test_pieces_hold_all_of_a_text():
    rng = random.Random(8)
    for text in ("a" * 50_000, "\n".join("x" * rng.randint(0, 900) for _ in range(200)), "y" * 30_000 + "\n" + "z" * 30_000):
        pieces = S._pieces(text)
        assert max(map(len, pieces)) <= S.PIECE + 1 and "".join(pieces).replace("\n", "") == text.replace("\n", "")


def plain_fit(rows, labels, epochs=8, batch=32, seed=7):
    """The perceptron with every batch scored by itself."""
    w, total, step, order = np.zeros(1 << S.BITS), np.zeros(1 << S.BITS), 1, np.random.default_rng(seed)
    for _ in range(epochs):
        mixed = order.permutation(len(rows))
        for i in range(0, len(mixed), batch):
            at = mixed[i : i + batch]
            off = at[labels[at] * w[rows[at]].sum(axis=1) <= 1]
            if len(off):
                flat, change = rows[off].ravel(), np.repeat(labels[off], rows.shape[1])
                np.add.at(w, flat, change)
                np.add.at(total, flat, step * change)
            step += 1
    return (w - total / step).astype(np.float32)


def test_training_costs_little_where_nothing_is_wrong():
    """The same weights as of single batches, in a good part of their time: batches that change nothing are scored together."""
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 1 << S.BITS, (40_000, 16))[rng.integers(0, 40_000, 60_001)]
    rows[:, 0] = rng.integers(0, 2, len(rows))
    hard = (rows[:500], np.where(rng.random(500) < 0.3, 1, -1))
    easy, mixed = rows[:, 0] * 2 - 1, np.where(rng.random(len(rows)) < 0.02, 1, rows[:, 0] * 2 - 1)
    assert np.array_equal(S.Averaged().fit(rows, mixed).w, plain_fit(rows, mixed))
    seconds = []
    for _ in range(3):
        began = time.thread_time()
        expect = plain_fit(rows, easy)
        between = time.thread_time()
        got = S.Averaged().fit(rows, easy).w
        seconds.append((between - began, time.thread_time() - between))
        assert np.array_equal(got, expect)
    assert np.array_equal(S.Averaged().fit(*hard).w, plain_fit(*hard))
    assert not S.Averaged().fit(rows[:0], hard[1][:0]).w.any()
    plain, together = map(min, zip(*seconds))
    assert together < 0.6 * plain


def test_counts_and_hashes_of_many_are_those_of_each():
    words = ["", "a", "short\x1f\x00é", "中文" * 12, "\ud800x\x00", "x" * 90]
    assert S.hash_texts(words).tolist() == [S.hash_text(x) for x in words] and not len(S.hash_texts([]))
    sample = [*texts(40, 31), "", "a", "b1c", "角" * 9, "x\ny"]
    codes, _ = S._arrays([t for t in sample if t])
    h, kinds = S._contexts(codes), S.CLASS[codes]
    letter = lambda i: kinds[i] in (S.CJK, S.LETTER) and i > 0 and S.BREAK not in (kinds[i - 1], kinds[i + 1])
    expect = Counter((int(h[i].view(np.int64)), int(codes[i])) for i in range(len(codes) - 1) if letter(i))
    got = S._context_counts(sample)
    assert {(a, c): n for a, c, n in got.itertuples(index=False)} == expect and not len(S._context_counts(["", "1"]))
    at = np.array([0, 7, 7, len(codes) - 1])
    assert np.array_equal(S._contexts(codes, at), h[at])
