import random

from quireflow.llm import leaks as L

rng = random.Random(12)
WORDS = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(400)]


def text(n, r):
    return " ".join(r.choice(WORDS) for _ in range(n))


def plain_edit_share(item, doc):
    """Least edits of any half of the item in the document, over its length, by full dynamic programming."""
    a, b = "".join(c for c in item.lower() if c.isalnum()), "".join(c for c in doc.lower() if c.isalnum())
    half, best = (len(a) + 1) // 2, 1.0
    for s in range(0, len(a) - half + 1, max(1, half // 6)):
        piece = a[s : s + half]
        row = [0] * (len(b) + 1)
        for i, x in enumerate(piece, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        best = min(best, min(row) / half)
    return best


def test_against_full_alignment(spark, get):
    r = random.Random(7)
    items = [text(30, r) for _ in range(8)]
    docs, kinds = [], []
    for k, item in enumerate(items):
        w = item.split()
        edited = [*w[:11], r.choice(WORDS), *w[12:]]
        docs += [text(20, r) + " " + item + " " + text(9, r), text(9, r) + " " + " ".join(w[:18]).upper().replace(" ", ",\n"), text(9, r) + " " + " ".join(w[20:27]) + " " + text(20, r), " ".join(edited), text(50, r)]
        kinds += [(k, True), (k, True), (k, False), (k, True), (k, False)]
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id long, text string, item_id string")
    e = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, item_text string")
    got = {tuple(x) for x in L.find_leaks(d, e).collect()}
    assert got == {(i, k) for i, (k, yes) in enumerate(kinds) if yes}
    for i, (k, yes) in enumerate(kinds):
        assert (plain_edit_share(items[k], docs[i]) <= 0.1) == yes
    # the same with items in several parts
    assert {tuple(x) for x in L.find_leaks(d, e, item_chars=600).collect()} == got


def test_edge_cases(spark, get):
    r = random.Random(9)
    item = text(20, r)
    data = [(1, None), (2, ""), (3, "!?"), (4, item), (4, item), (5, (text(2000, r) + " " + item + " ") * 3), (6, "\x02" + item)]
    d = spark.createDataFrame(data, "doc_id long, text string")
    e = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "short")], "item_id long, item_text string")
    assert get(L.find_leaks(d, e)) == [(4, 1), (5, 1), (6, 1)]
    assert L.find_leaks(d.limit(0), e).count() == 0 and L.find_leaks(d, e.limit(0)).count() == 0


def test_half_of_short_items(spark):
    r = random.Random(3)
    items = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)) for n in range(12, 24) for _ in range(4)]
    docs = ["".join(r.choice("ABCDEFGH") for _ in range(30)) + x[: (len(x) + 1) // 2] + "".join(r.choice("ABCDEFGH") for _ in range(30)) for x in items]
    index = L.build_index(list(range(len(items))), items)
    found = L.leaks_in(docs, index, L.np.unpackbits(index.filter).view(bool))
    assert {(k, k) for k in range(len(items))} <= set(found)


def brute_leak(a, b):
    """Whether a passage of s >= n / 2 characters stands in b with at most ERROR_RATE * s edits, from every start, by plain dynamic programming."""
    n = len(a)
    for i in range(n):
        row = [0] * (len(b) + 1)
        for s in range(1, n - i + 1):
            last, row[0] = row[0], s
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a[i + s - 1] != y))
            if s >= (n + 1) // 2 and min(row) <= L.ERROR_RATE * s + 1e-9:
                return True
    return False


def test_exactly_as_brute_force():
    r = random.Random(21)
    item = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60))
    docs = []
    for _ in range(60):
        a = r.randrange(0, 30)
        piece = list(item[a : a + r.randrange(26, 60)])
        for _ in range(r.randrange(0, 6)):
            at = r.randrange(len(piece))
            piece[at : at + r.choice((0, 1, 1))] = r.choice(("", "Q", "q", "zz"))
        docs.append("".join(r.choice("xyzw") for _ in range(9)) + "".join(piece).lower() + "".join(r.choice("xyzw") for _ in range(9)))
    index = L.build_index([0], [item])
    found = {d for d, _ in L.leaks_in(docs, index, L.np.unpackbits(index.filter).view(bool))}
    assert found == {k for k, d in enumerate(docs) if brute_leak(item, d)} and 10 < len(found) < 55


def test_one_half_reworded_and_pieces_of_huge_texts(monkeypatch):
    r = random.Random(5)
    item = text(40, r)
    half = item[: len(item) // 2 + 4]
    docs = [text(30, r) + half + text(20, r).replace("e", "a"), text(3000, r) + item + text(500, r), text(3000, r)]
    index = L.build_index([7], [item])
    bits = L.np.unpackbits(index.filter).view(bool)
    assert L.leaks_in(docs, index, bits) == [(0, 0), (1, 0)]
    monkeypatch.setattr(L, "BLOCK", 1000)
    assert L.leaks_in(docs, index, bits) == [(0, 0), (1, 0)]
