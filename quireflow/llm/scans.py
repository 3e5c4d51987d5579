"""Repair of text from scanned pages.

An averaged perceptron edits characters. Its operations are keep, replace by a
character, delete, insert, and join a word cut at a line end; lines are kept or
deleted as running header, page number or both. Every operation has weights of its own
over hashed features of the characters around the place and, for lines, of the line's
place on its page; the operation with the highest score is done, keep counts zero.
Line breaks inside a paragraph become blanks or nothing.

Which operations are possible at a character comes from a noise model: what a scanner
makes of what. It starts from a short list of confusions and learns further ones from
the texts themselves: characters that stand, rarely but in many different contexts, where
one other character nearly always stands. There are no labelled scans, so the perceptron
is trained on noise that this model puts into the unwrapped texts of the same corpus, all of
them: shards of texts train weights of their own, whose mean the editor has.

Features are taken from folded characters, so that text typed with look-alikes is read
the same; the repaired text consists of the characters as they were.
"""

from __future__ import annotations

import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import Scratch
from .lookalikes import CLASS_OF, PLAIN

#: Characters of a piece in which a very long text is trained on.
PIECE = 20_000
#: Weights of the hashed features.
BITS = 22
#: Bits of the bitmap of contexts, and what spreads their usual characters over it.
MARK_BITS, MARK = 26, 2654435761
#: Characters of the texts from which one shard trains weights of its own; the editor has the mean of all shards.
SHARD = 2_500_000
#: Characters that are worked on at once; bounds the memory of a Python worker.
BLOCK = 400_000
#: The same where contexts are counted; the more at once, the fewer rows of counts.
COUNTED = 1_000_000

# Chinese characters and their misreadings, with which the noise model starts.
MISREAD_CJK = dict(zip("为数求于的每比面大设角再未天已直", "力敎术干旳毎此靣犬没甬冉末夭己宜", strict=True))
# Letters inside words and their misreadings; two letters for one, and one for two.
MISREAD_WORD = {"o": "0", "l": "1", "m": "rn", "t": "f", "h": "b", "n": "u", "d": "cl", "rn": "m", "cl": "d"}
# Digits inside numbers and their misreadings.
MISREAD_DIGIT = {"1": "l", "0": "O", "5": "S", "8": "B", "6": "b"}
# Specks that are read as marks between letters.
SPECKS = "`~^·"
# Marks at the end of a line after which a word goes on.
CUT_MARKS = "-‐¬\xad"
#: What makes a learned confusion: times that a context occurs, share of its usual character, different contexts, their share among the contexts of the usual character, bounds of its rate, and share of one usual character among all that the other stands for.
MIN_TIMES, USUAL, MIN_CONTEXTS, SPREAD, RATES, ONE = 10, 0.8, 5, 0.25, (0.002, 0.06), 0.8

OTHER, DIGIT, LETTER, CJK, BLANK, END, PUNCT, BREAK = range(8)
SEP = 2  # between texts
N_CODES = 0x110000
CUTS = np.array([ord(c) for c in CUT_MARKS], np.uint32)


def _class_table() -> np.ndarray:
    t = np.zeros(N_CODES, np.uint8)
    t[48:58] = DIGIT
    for a, b in ((65, 91), (97, 123), (0xC0, 0x250), (0x300, 0x370)):
        t[a:b] = LETTER
    t[0x3400:0xA000] = CJK
    for c in " \t　\xa0":
        t[ord(c)] = BLANK
    for c in "。！？.!?":
        t[ord(c)] = END
    for c in "，；：、,;:$=（）()【】．%<>+…①②③④^\\{}_":
        t[ord(c)] = PUNCT
    t[10] = t[13] = t[SEP] = BREAK
    return t


CLASS = _class_table()


class _Fold:
    """Code -> the code that reads the same, 0 for an ignorable one; filled for the codes that occur. Punctuation keeps its width."""

    def __init__(self) -> None:
        self.to, self.known = np.arange(N_CODES, dtype=np.uint32), np.zeros(N_CODES, bool)
        self.known[:0x80] = self.known[0x4E00:0xA000] = self.known[0x3000:0x3003] = True
        for c in CUT_MARKS + "，；：？！（）．":
            self.known[ord(c)] = True

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        new = codes[~self.known[codes]]
        for code in np.unique(new):
            ch = chr(code)
            plain = PLAIN[int(code)] if not 0xD800 <= code < 0xE000 else ch
            if plain is None:
                self.to[code] = 0
            elif len(plain) == 1:
                self.to[code] = CLASS_OF.get(ord(plain), plain) if isinstance(CLASS_OF.get(ord(plain), plain), int) else ord(CLASS_OF.get(ord(plain), plain))
            self.known[code] = True
        return self.to[codes]


FOLD = _Fold()


class Averaged:
    """An averaged perceptron over hashed features; a row of features belongs to one operation at one place."""

    def __init__(self, weights: np.ndarray | None = None):
        self.w = np.zeros(1 << BITS, np.float32) if weights is None else weights

    def fit(self, rows: np.ndarray, labels: np.ndarray, epochs: int = 8, batch: int = 32, seed: int = 7) -> Averaged:
        """Labels are 1 for the right operation of a place and -1 for the others; updates are made in small batches.

        A batch with all rows on the right side changes nothing, so several batches are scored at once and those
        before the first with a row on the wrong side are done. Weights are whole numbers until the end, so their
        sums are the same in any order.
        """
        used = np.zeros(1 << BITS, bool)
        used[rows.ravel()] = True
        used = np.flatnonzero(used)
        number = np.zeros(1 << BITS, np.int32)
        number[used] = np.arange(len(used))
        columns = number[rows].astype(np.int64)  # only weights that occur
        w, total, step, ones = np.zeros(len(used)), np.zeros(len(used)), 1, np.ones(rows.shape[1])
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            mixed = order.permutation(len(rows))
            own, right, i, ahead, changes = columns[mixed], labels[mixed].astype(float), 0, batch, []
            while i < len(mixed):
                # a margin of one keeps rare contexts on the right side
                off = (right[i : i + ahead] * (w.take(own[i : i + ahead]) @ ones) <= 1).nonzero()[0]
                if not len(off):
                    step += -(-min(ahead, len(mixed) - i) // batch)
                    i, ahead = i + ahead, min(2 * ahead, 32 * batch)
                    continue
                sound = int(off[0]) // batch
                off = i + off[: off.searchsorted((sound + 1) * batch)]
                step += sound
                flat, change = own[off].ravel(), right[off].repeat(len(ones))
                np.add.at(w, flat, change)
                changes.append((flat, step * change))
                step += 1
                i, ahead = i + (sound + 1) * batch, min(ahead, 2 * (sound + 1) * batch)
            if changes:
                np.add.at(total, *map(np.concatenate, zip(*changes)))
        self.w = np.zeros(1 << BITS, np.float32)
        self.w[used] = w - total / step
        return self

    def score(self, rows: np.ndarray) -> np.ndarray:
        return self.w[rows].sum(axis=1) if len(rows) else np.zeros(0)


def _hash(*parts: np.ndarray | int) -> np.ndarray:
    h = np.uint64(1469598103934665603)
    with np.errstate(over="ignore"):
        for p in parts:
            h = h ^ np.asarray(p).astype(np.uint64, copy=False)
            h *= np.uint64(1099511628211)
            h ^= h >> np.uint64(29)
        return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


#: Windows of offsets around a place; the character itself belongs to each.
WINDOWS = ((), (-1,), (1,), (-1, 1), (-2, -1), (1, 2), (-3, -2, -1), (1, 2, 3), (-2, -1, 1), (-1, 1, 2), (-2, -1, 1, 2), (-3, -2, -1, 1), (-1, 1, 2, 3), (-4, -3, -2, -1), (1, 2, 3, 4), (-3, -2, -1, 1, 2, 3))


def around(codes: np.ndarray, at: np.ndarray, kind: np.ndarray | int, after: np.ndarray | int = 0) -> np.ndarray:
    """Features of places: hashed windows with all digits alike. ``kind``: the operation; ``after``: further length of the place."""
    if not len(at):
        return np.zeros((0, len(WINDOWS)), np.int64)
    cls = CLASS[codes]
    same = np.where(cls == DIGIT, np.uint32(48), np.where(cls == BREAK, np.uint32(SEP), codes))
    pad = 8
    same = np.concatenate([np.full(pad, SEP, np.uint32), same, np.full(pad, SEP, np.uint32)])
    get = {k: same[at + pad + k + (after if k > 0 else 0)] for k in range(-4, 5) if k}
    for side in (-1, 1):  # nothing is seen beyond the end of a text or paragraph
        for k in range(2, 5):
            get[side * k] = np.where(CLASS[get[side * (k - 1)]] == BREAK, np.uint32(SEP), get[side * k])
    get = {k: x.astype(np.uint64) for k, x in get.items()}
    me, kind = codes[at].astype(np.uint64), np.asarray(kind).astype(np.uint64)
    return np.stack([_hash(kind, n, me, *(get[k] for k in w)) for n, w in enumerate(WINDOWS)], axis=1)


@dataclass(frozen=True)
class Edit:
    """An operation on characters: ``bad`` becomes ``right``. Equal lengths replace, others delete or insert as well. ``where``: the surroundings in which the noise occurs."""

    bad: str
    right: str
    where: str

    @property
    def kind(self) -> int:
        return hash_text(f"{self.bad}\x1f{self.right}\x1f{self.where}")


def _where(bad: str, right: str) -> str:
    if "一" <= right[:1] <= "鿿" or right[:1] >= "\u3400":
        return "any"
    return "speck" if not right else "number" if right.isdigit() else "word"


class NoiseModel:
    """The edits that undo what scanners do, and the same the other way round as a source of noise."""

    def __init__(self, learned: list[tuple[str, str]] = ()):
        seeds = [(bad, right) for table in (MISREAD_CJK, MISREAD_WORD, MISREAD_DIGIT) for right, bad in table.items()] + [(c, "") for c in SPECKS]
        self.learned, self.sure = [x for x in learned if x not in seeds], set(learned)
        self.edits = [Edit(bad, right, _where(bad, right)) for bad, right in [*seeds, *self.learned]]
        self.kinds = np.array([e.kind for e in self.edits], np.int64)
        self.more = np.array([len(e.bad) - 1 for e in self.edits], np.int64)
        by = defaultdict(list)
        for k, e in enumerate(self.edits):
            if len(e.bad) == 1:
                by[ord(e.bad)].append(k)
        self.single = np.full(N_CODES, -1, np.int16)
        self.lists = list(by.values())
        for k, code in enumerate(by):
            self.single[code] = k
        self.double = [(ord(e.bad[0]), ord(e.bad[1]), k) for k, e in enumerate(self.edits) if len(e.bad) == 2]
        self.made: dict[str, list[Edit]] = defaultdict(list)
        for e in self.edits:
            self.made[e.right].append(e)
        # the longer ones first
        several, single = sorted((r for r in self.made if len(r) > 1), key=lambda r: (-len(r), r)), "".join(sorted(r for r in self.made if len(r) == 1))
        self.rights = re.compile("|".join([*map(re.escape, several), f"[{re.escape(single)}]"]))

    def places(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, number of the edit) of all edits that are possible, by place."""
        cls = CLASS[codes]
        slot = self.single[codes]
        at = np.flatnonzero(slot >= 0)
        sizes = np.array([len(x) for x in self.lists] or [0])
        flat, first = np.array([k for x in self.lists for k in x], np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]])
        n = sizes[slot[at]] if len(at) else np.zeros(0, np.int64)
        edit = flat[np.repeat(first[slot[at]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] if len(at) else np.zeros(0, np.int64)
        at = np.repeat(at, n)
        for a, b, k in self.double:
            both = np.flatnonzero(codes[:-1] == a)
            both = both[codes[both + 1] == b]
            at, edit = np.concatenate([at, both]), np.concatenate([edit, np.full(len(both), k)])
        order = np.lexsort((edit, at))
        at, edit = at[order], edit[order]
        padded = np.concatenate([[BREAK], cls, [BREAK, BREAK]])
        prev, after = padded[at], padded[at + 2 + self.more[edit]]
        lp, ln, dp, dn, digit = prev == LETTER, after == LETTER, prev == DIGIT, after == DIGIT, cls[at] == DIGIT
        where = np.array([("any", "word", "number", "speck").index(e.where) for e in self.edits])[edit]
        in_word = np.where(digit, ~dp & (ln | (lp & ~dn)), lp | ln | (self.more[edit] > 0))
        ok = np.select([where == 0, where == 1, where == 2], [np.ones(len(at), bool), in_word, dp | dn | (~lp & ~ln)], lp & ln)
        return at[ok], edit[ok]

    def noisy(self, text: str, rng: random.Random, rate: float) -> tuple[str, list[tuple[int, Edit]]]:
        """The text with misreadings, and their places in it."""
        if not rate:
            return text, []
        chosen, draw = [], rng.random
        for m in self.rights.finditer(text):
            if draw() < rate:
                e = rng.choice(self.made[m[0]])
                near = text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1]
                if e.where != "word" or (any(x.isalpha() for x in near) and all(x.isalpha() and x.isascii() or x in " ,.'" for x in near)):
                    chosen.append((m.start(), m.end(), e))
        for _ in range(int(rng.random() < rate * len(text) / 20)):
            i = rng.randrange(1, len(text)) if len(text) > 1 else 0
            if text[max(0, i - 1) : i + 1].isalpha() and text[max(0, i - 1) : i + 1].isascii() and i:
                chosen.append((i, i, rng.choice(self.made[""])))
        out, done, at, size = [], [], 0, 0
        for a, b, e in sorted(chosen, key=lambda x: x[:2]):
            if a < at:
                continue
            out += [text[at:a], e.bad]
            done.append((size + a - at, e))
            size, at = size + a - at + len(e.bad), b
        return "".join([*out, text[at:]]), done


def _contexts(codes: np.ndarray, at: np.ndarray | slice = slice(None)) -> np.ndarray:
    """The hash of the three characters on both sides of each place."""
    n = len(codes)
    same = np.concatenate([np.full(3, SEP, np.uint32), np.where(CLASS[codes] == DIGIT, np.uint32(48), codes), np.full(3, SEP, np.uint32)])
    get = {k: same[3 + k : 3 + k + n][at] for k in (-3, -2, -1, 1, 2, 3)}
    for side in (-1, 1):
        for k in (2, 3):
            get[side * k] = np.where(CLASS[get[side * (k - 1)]] == BREAK, np.uint32(SEP), get[side * k])
    h = np.zeros(len(get[1]), np.uint64)
    with np.errstate(over="ignore"):
        for k in (-3, -2, -1, 1, 2, 3):
            h = (h ^ get[k]) * np.uint64(1099511628211)
            h ^= h >> np.uint64(29)
    return h


def _context_counts(texts: list[str]) -> pd.DataFrame:
    """(context, c, n): how often each letter between others stands in each context."""
    codes, _ = _arrays([t for t in texts if t] or [""])
    cls = np.concatenate([[BREAK], CLASS[codes], [BREAK]])
    ok = ((cls[1:-1] == CJK) | (cls[1:-1] == LETTER)) & (cls[:-2] != BREAK) & (cls[2:] != BREAK)
    number, contexts = pd.factorize(_contexts(codes)[ok])
    both = np.sort((number << 21) | codes[ok])
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])[: len(both)])
    return pd.DataFrame({"context": contexts[both[first] >> 21].view(np.int64), "c": both[first] & ((1 << 21) - 1), "n": np.diff(np.append(first, len(both)))})


def learn_confusions(texts: list[str]) -> tuple[list[tuple[str, str]], tuple[np.ndarray, np.ndarray]]:
    """(misread, right) pairs: characters of which the first stands for the second as a scanner's error; and the contexts that have a usual character, sorted, with that.

    A misreading does not depend on its surroundings. So of all contexts (three
    characters on both sides) in which one character is usual, another that is an error
    of it stands in a good part, everywhere with a small rate, and for no other usual
    character; natural alternatives are frequent in few contexts, or stand for many.
    """
    seen = _context_counts(texts)
    if not len(seen):
        return [], (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
    seen["all"] = seen.groupby("context").n.transform("sum")
    usual = seen.sort_values(["n", "c"], ascending=[False, True]).drop_duplicates("context")
    usual = usual[(usual["all"] >= MIN_TIMES) & (usual.n >= USUAL * usual["all"])]
    of = usual.groupby("c").agg(contexts=("n", "size"), times=("n", "sum")).reset_index().rename(columns={"c": "right"})
    odd = seen.merge(usual[["context", "c"]].rename(columns={"c": "right"}), on="context")
    odd = odd[odd.c != odd.right].groupby(["c", "right"]).agg(k=("n", "size"), n=("n", "sum")).reset_index()
    at = np.argsort(usual.context.to_numpy().view(np.uint64))
    return _confusions(odd.merge(of, on="right")), (usual.context.to_numpy().view(np.uint64)[at], usual.c.to_numpy().astype(np.uint32)[at])


def _confusions(odd: pd.DataFrame) -> list[tuple[str, str]]:
    """The pairs that are errors, of all pairs of an odd and a usual character: ``k`` contexts and ``n`` times with both, and ``contexts`` and ``times`` of the usual one."""
    back = set(zip(odd.right, odd.c))
    one = odd.n / odd.groupby("c").n.transform("sum")
    good = odd[(odd.k >= MIN_CONTEXTS) & (odd.k >= SPREAD * odd.contexts) & (odd.n / odd.times).between(*RATES) & (one >= ONE)]
    return sorted((chr(c), chr(r)) for c, r in zip(good.c, good.right) if (c, r) not in back)


def confusions_of(records: DataFrame, scratch: Scratch) -> tuple[list[tuple[str, str]], np.ndarray | None]:
    """The same from all texts, by distributed counts; and a bitmap of the contexts (``_mark``) whose usual character some learned pair restores.

    To the driver come the learned pairs (filtered by Spark) and the bitmap, of fixed size; two contexts that
    share a bit can only leave a place out of the training.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in _blocks(batch.text, COUNTED):
                yield _context_counts(batch.text.iloc[a:b].tolist())

    seen = records.select("text").filter(F.col("text") != "").mapInPandas(count, "context long, c long, n long").groupBy("context", "c").agg(F.sum("n").alias("n"))
    # a count and a character in one number: the largest is that of the most frequent character, the first of several
    last = (1 << 21) - 1
    both = seen.select("context", "n", ((F.col("n") * (last + 1)) + (last - F.col("c"))).alias("x"))
    contexts = both.groupBy("context").agg(F.sum("n").alias("all"), F.max("x").alias("best"), F.collect_list("x").alias("has"))
    contexts = contexts.select("context", "all", F.shiftright("best", 21).alias("most"), (last - F.col("best").bitwiseAND(last)).alias("right"), "has")
    usual = scratch.put(contexts.filter((F.col("all") >= MIN_TIMES) & (F.col("most") >= USUAL * F.col("all"))), "usual")
    of = usual.groupBy("right").agg(F.count(F.lit(1)).alias("contexts"), F.sum("most").alias("times"))
    odd = usual.select("right", F.explode("has").alias("x")).select("right", (last - F.col("x").bitwiseAND(last)).alias("c"), F.shiftright("x", 21).alias("n")).filter("c != right").groupBy("c", "right").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    learned = _confusions(odd.join(of, "right").toPandas())
    rights = [ord(r) for _, r in learned]
    if not rights:
        return [], None
    marks = usual.filter(F.col("right").isin(rights)).select(F.expr(f"(context ^ (right * {MARK})) & {(1 << MARK_BITS) - 1}").alias("m"))
    words = marks.groupBy(F.expr("shiftright(m, 5)").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(m & 31 as int))")).alias("bits")).toPandas()
    bitmap = np.zeros(1 << (MARK_BITS - 5), np.uint32)
    bitmap[words.w.to_numpy()] = words.bits.to_numpy().astype(np.uint32)
    return learned, bitmap


def _marked_context(h: np.ndarray, right: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    m = (h.view(np.int64) ^ (right.astype(np.int64) * MARK)) & ((1 << MARK_BITS) - 1)
    return (bitmap[m >> 5] >> (m & 31).astype(np.uint32)) & 1 > 0


def _raw(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array of codes, each ended by SEP, and the number of the text of each code."""
    lens = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    raw = np.frombuffer(chr(SEP).join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), lens)
    if (raw == SEP).sum() != len(texts):  # a text holds the separator itself
        raw = np.where((raw == SEP) & ~_last(lens), np.uint32(32), raw)
    return raw, doc


def _arrays(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The same with folded codes, without ignorable ones."""
    raw, doc = _raw(texts)
    codes = FOLD(raw)
    keep = codes != 0
    return codes[keep], doc[keep]


def _last(lens: np.ndarray) -> np.ndarray:
    out = np.zeros(int(lens.sum()), bool)
    out[np.cumsum(lens) - 1] = True
    return out


# ---- furniture: whole lines -------------------------------------------------

DIGITS = "[0-9OlSBb]"
PAGE_FORM = re.compile(rf"(?:[-—·–]\s*{DIGITS}+\s*[-—·–]|\[{DIGITS}+\]|第\s*{DIGITS}+\s*页(?:\s*共\s*{DIGITS}+\s*页)?|(?:[Pp]age|[Pp]\.)\s*{DIGITS}+(?:\s*of\s*{DIGITS}+)?|{DIGITS}+\s*/\s*{DIGITS}+|{DIGITS}+)", re.I)
BESIDE = re.compile(rf"^{DIGITS}+[\s　]{{2,}}(?=\D)|(?<=\S)[\s　]{{2,}}{DIGITS}+$")


def _h(*parts: object) -> int:
    return hash_text("\x1f".join(map(str, parts)))


def hash_text(s: str) -> int:
    h = 1469598103934665603
    for b in s.encode("utf-8", "surrogatepass"):
        h = ((h ^ b) * 1099511628211) & 0xFFFFFFFFFFFFFFFF
    return ((h * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> (64 - BITS)


def hash_texts(texts: list[str]) -> np.ndarray:
    """``hash_text`` of many short texts at once."""
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.fromiter(map(len, data), np.int64, len(data))
    width, longest = int(size.max(initial=1)), np.argsort(-size)
    codes = np.ascontiguousarray(np.array(data, f"S{width}").view(np.uint8).reshape(len(data), width)[longest].T)
    h = np.full(len(data), 1469598103934665603, np.uint64)
    with np.errstate(over="ignore"):
        for column, n in zip(codes, len(data) - np.searchsorted(np.sort(size), np.arange(width), "right")):
            h[:n] ^= column[:n]
            h[:n] *= np.uint64(1099511628211)
        out = np.empty(len(data), np.int64)
        out[longest] = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    return out


class _Seen(dict):
    """What was asked, with the hashes that ``of`` gives for it."""

    def __init__(self, of) -> None:
        self.of = of

    def __missing__(self, asked: str | tuple) -> int | list[int]:
        if len(self) > 500_000:
            self.clear()
        out = self[asked] = self.of(asked)
        return out


def _shape(asked: tuple) -> list[int]:
    kind, page, ends, goes, bare, place, size, gap, words, beside = asked
    return [_h("kind", kind, page), _h("ends", kind, ends, bare), _h("goes", kind, goes, bare), _h("place", kind, place, bare), _h("size", kind, size), _h("all", kind, ends, goes, bare), _h("gap", kind, gap, bare), _h("both", ends, goes, place, bare, page), _h("words", kind, words), _h("page", page, beside)]


_GRAMS, _SHAPES = _Seen(lambda x: _h("g", x)), _Seen(_shape)
_HEADS, _TAILS = _Seen(lambda x: [_h("head", x[:1]), _h("head2", x[:2]), _h("head3", x)]), _Seen(lambda x: [_h("tail", x[-1:]), _h("tail2", x[-2:]), _h("tail3", x)])
_HAN, _DIGITS, _ZEROS = re.compile("[一-鿿]"), re.compile(r"\d"), re.compile("0+")

MAX_LINE_FEATURES = 48
THREES = [slice(i, i + 3) for i in range(MAX_LINE_FEATURES)]
#: What a line may be beside text: a running header, a page number, a header with a page number; and what tells their weights apart.
LINE_KINDS = {"header": 0x1B873593, "page": 0x2545F491, "both": 0x3C6EF372}


def of_kind(rows: np.ndarray, kind: str) -> np.ndarray:
    return (rows ^ LINE_KINDS[kind]) & ((1 << BITS) - 1)


def line_features(line: str, before: str, after: str, first: bool, last: bool, width: int, gap: bool) -> tuple[list[int], str]:
    """Features of one line: its shape, its characters, and its place between the lines around it. The second is left open for the hash of the text that is returned."""
    s = _DIGITS.sub("0", line)
    words = s.split()
    compact = "".join(words)
    short = _ZEROS.sub("0", compact)
    numeric = "0" in compact and not any(c.isalpha() for c in compact)
    spaced = len(words) > 3 and max(map(len, words)) <= 2
    end = before[-1:]
    ends = "none" if not before else "colon" if end in "：:" else "end" if end in "。.！？!?．" else "open"
    goes = "none" if not after else "low" if after[0].islower() else "punct" if not after[0].isalnum() else "other"
    place = "first" if first else "last" if last else "mid"
    size = min(6, int(6 * len(line) / max(1, width)))
    kind = ("n" if numeric else "s" if spaced else "u" if compact.isupper() else "t" if words and all(not w[:1].islower() for w in words) else "x")
    page = bool(PAGE_FORM.fullmatch(line))
    bare = compact.isdigit()
    shape = _SHAPES[kind, page, ends, goes, bare, place, size, gap, min(9, len(words)), len(s) - len(compact) != len(words) - 1 and bool(BESIDE.search(line))]
    out = [shape[0], 0, *shape[1:8], *_HEADS[short[:3]], *_TAILS[short[-3:]], *shape[8:]]
    body = short if _HAN.search(short) else " ".join(words).lower()
    out += map(_GRAMS.__getitem__, map(body.__getitem__, THREES[: max(0, min(len(body) - 2, MAX_LINE_FEATURES - len(out)))]))
    return out + [0] * (MAX_LINE_FEATURES - len(out)), f"short\x1f{short[:24]}"


def _between(places: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many of the sorted places lie in each range."""
    return np.searchsorted(places, end) - np.searchsorted(places, start)


class Lines:
    """The lines of all texts of a block, with what the furniture search needs of each."""

    def __init__(self, codes: np.ndarray, doc: np.ndarray):
        cls = CLASS[codes]
        self.end = np.flatnonzero(cls == BREAK)
        self.start = np.concatenate([[0], self.end[:-1] + 1])
        self.doc = doc[self.end]
        solid = np.flatnonzero((cls != BLANK) & (cls != BREAK))
        last = np.concatenate([[-1], solid])[np.searchsorted(solid, self.end)]
        count = lambda k: _between(np.flatnonzero(cls == k), self.start, self.end)
        self.digits, self.punct, ends = count(DIGIT), count(PUNCT), count(END)
        self.blanks = count(BLANK)
        self.size = np.where(last >= self.start, last - self.start + 1, 0)
        self.multi = np.bincount(self.doc, minlength=int(doc[-1]) + 1)[self.doc] > 1
        short = self.size - self.blanks <= 40
        self.candidate = self.multi & (self.size > 0) & short & ((self.punct + ends == 0) | ((self.size <= 26) & (self.digits > 0) & (self.punct <= 1) & (ends <= 1)))


def find_furniture(codes: np.ndarray, doc: np.ndarray, model: Averaged) -> tuple[Lines, list[tuple[int, bool, bool]]]:
    """(number of the line, whether a header, whether a page number) of the furniture."""
    lines, found = Lines(codes, doc), []
    at = np.flatnonzero(lines.candidate)
    if not len(at):
        return lines, found
    rows = features_of(lines, codes, at.tolist())
    scores = np.stack([model.score(of_kind(rows, kind)) for kind in LINE_KINDS])
    best = scores.argmax(axis=0)
    for i, k, s in zip(at.tolist(), best.tolist(), scores.max(axis=0).tolist()):
        if s > 0:
            found.append((i, k != 1, k != 0))
    return lines, found


def features_of(lines: Lines, codes: np.ndarray, at: list[int]) -> np.ndarray:
    """Features of the lines ``at``; the lines around are the nearest ones that are not blank and no page marks themselves."""
    text = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    start, end, doc, candidate, n = lines.start.tolist(), lines.end.tolist(), lines.doc.tolist(), lines.candidate.tolist(), len(lines.doc)
    strings: list[str | None] = [None] * n
    marked: list[bool | None] = [None] * n

    def string(i: int) -> str:
        s = strings[i]
        if s is None:
            s = strings[i] = text[start[i] : end[i]].strip(" \t　\xa0\r")
        return s

    def nearest(i: int, way: int) -> tuple[str, bool]:
        d, gap, j = doc[i], False, i + way
        while 0 <= j < n and doc[j] == d:
            s = string(j)
            if not s:
                gap = True
            else:
                if marked[j] is None:
                    marked[j] = candidate[j] and _marked(s)
                if not marked[j]:
                    return s, gap
            j += way
        return "", gap

    out, open_ = [], []
    for i in at:
        (before, above), (after, below) = nearest(i, -1), nearest(i, 1)
        features, text_of = line_features(string(i), before, after, not before, not after, max(len(before), len(after)), above or below)
        out += features
        open_.append(text_of)
    rows = np.array(out, np.int64).reshape(-1, MAX_LINE_FEATURES)
    rows[:, 1] = hash_texts(open_)
    return rows


_MARKED = re.compile(r"第[\s　]*[一二三四五六七八九十百\d]+[\s　]*[章册页]|^(?:page|p\.|chapter)\s*\d|^[-—·–\[]\s*\d+\s*[-—·–\]]$|^\d+\s*/\s*\d+$", re.I)


def _capital(s: str) -> bool:
    """Whether no word of a line of several words begins with a small letter."""
    words = s.split()
    return len(words) > 1 and any(w[:1].isupper() for w in words) and not any(w[:1].islower() for w in words)


def _marked(s: str) -> bool:
    """Whether a line shows by its form that it belongs to the page and not to the text."""
    return s[-1:] not in "。，；.,;" and bool(_MARKED.search(s))


# ---- joining and misreadings ------------------------------------------------


def join_lines(codes: np.ndarray, doc: np.ndarray, furniture: np.ndarray, model: Averaged) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, texts and places in ``codes`` (-1 for a new blank or break) without furniture and line breaks; and the numbers of the texts in which a word was joined.

    A run of blanks with one line break in it becomes nothing beside a Chinese character
    and a blank elsewhere; with several breaks, and no furniture, it stays a break.
    """
    cls = CLASS[codes]
    white = (((cls == BLANK) | (cls == BREAK)) & (codes != SEP)) | furniture
    edge = np.flatnonzero(np.diff(np.concatenate([[0], white.astype(np.int8), [0]])))
    a, b = edge[::2], edge[1::2]
    if not len(a):
        return codes, doc, np.arange(len(codes)), np.zeros(0, np.int64)
    n, gone = _between(np.flatnonzero((codes == 10) & ~furniture), a, b), _between(np.flatnonzero(furniture), a, b)
    some = (n > 0) | (gone > 0)
    a, b, n, gone = a[some], b[some], n[some], gone[some]
    left, right = codes[np.maximum(a - 1, 0)], codes[np.minimum(b, len(codes) - 1)]
    lc, rc = CLASS[left], CLASS[right]
    wide = lambda c, k: (k == CJK) | ((c >= 0x3000) & (c < 0x3040)) | ((c >= 0xFF00) & (c < 0xFFF0))
    cut = np.isin(left, CUTS) & (CLASS[codes[np.maximum(a - 2, 0)]] == LETTER) & (rc == LETTER) & (a > 1)
    if cut.any():
        at = np.flatnonzero(cut)
        # the place is the mark; what follows is the next line
        rows = _cut_features(codes, a[at] - 1, b[at])
        cut[at[model.score(rows) <= 0]] = False
    # blanks without a break stay as they are
    keep = np.ones(len(codes), bool)
    keep[np.repeat(a - np.cumsum(b - a) + (b - a), b - a) + np.arange((b - a).sum())] = False
    stay = (n > 1) & (gone == 0)
    blank = ~stay & ~cut & ~(wide(left, lc) | wide(right, rc)) & (left != SEP) & (right != SEP) & (a > 0)
    out, new = codes.copy(), np.zeros(len(codes), bool)
    out[a[stay]] = 10
    out[a[blank]] = 32
    new[a[stay | blank]] = keep[a[stay | blank]] = True
    keep[a[cut] - 1] = False
    place = np.flatnonzero(keep)
    return out[place], doc[place], np.where(new[place], -1, place), np.unique(doc[a[cut]])


def _cut_features(codes: np.ndarray, mark: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    return around(codes, mark, 2, nxt - mark - 1)


def find_misreadings(codes: np.ndarray, model: Averaged, noise: NoiseModel) -> tuple[np.ndarray, np.ndarray]:
    """(place, number of the edit): at each place the edit with the highest score, where that is above the zero of keeping."""
    at, edit = noise.places(codes)
    score = model.score(around(codes, at, noise.kinds[edit], noise.more[edit]))
    above = score > 0
    at, edit, score = at[above], edit[above], score[above]
    order = np.lexsort((edit, -score, at))
    at, edit = at[order], edit[order]
    best = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
    return at[best], edit[best]


class Editor:
    """The trained editor: weights of the operations on characters, weights of those on lines, and the noise model."""

    def __init__(self, chars: Averaged, lines: Averaged, noise: NoiseModel):
        self.chars, self.lines, self.noise = chars, lines, noise

    def edit(self, texts: list[str], repair: bool = True) -> tuple[list[str] | None, dict[str, set[int]]]:
        """Repaired texts (None unless wanted) and, for each kind of noise, the numbers of the texts with it."""
        noise: dict[str, set[int]] = {"split_word": set(), "misread": set(), "running_header": set(), "page_number": set()}
        raw, doc = _raw(texts)
        folded = FOLD(raw)
        source = np.flatnonzero(folded != 0)
        codes, doc = folded[source], doc[source]
        lines, found = find_furniture(codes, doc, self.lines)
        furniture = np.zeros(len(codes), bool)
        for i, header, page in found:
            furniture[lines.start[i] : lines.end[i]] = True
            if header:
                noise["running_header"].add(int(lines.doc[i]))
            if page:
                noise["page_number"].add(int(lines.doc[i]))
        codes, doc, place, joined = join_lines(codes, doc, furniture, self.chars)
        noise["split_word"].update(map(int, joined))
        at, edit = find_misreadings(codes, self.chars, self.noise)
        # a letter of another script than Latin is no misread Latin letter, however it is drawn
        was = np.where(place >= 0, raw[source[np.maximum(place, 0)]], codes)[at]
        same = ~((was >= 0x370) & (was < 0x530))
        at, edit = at[same], edit[same]
        noise["misread"].update(map(int, np.unique(doc[at])))
        if not repair:
            return None, noise
        # the characters as they were, each with the ignorable ones behind it
        behind = np.diff(np.append(source, len(raw))) - 1
        old = place >= 0
        size = np.where(old, 1 + behind[np.maximum(place, 0)], 1)
        start = np.concatenate([[0], np.cumsum(size)])
        index = np.repeat(np.where(old, source[np.maximum(place, 0)], 0), size) + np.arange(start[-1]) - np.repeat(start[:-1], size)
        text = np.where(np.repeat(old, size), raw[index], np.repeat(codes, size)).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        parts, done = [], 0
        for i, k in zip(at.tolist(), edit.tolist()):
            if start[i] >= done:
                parts += [text[done : start[i]], self.noise.edits[k].right]
                done = int(start[i + len(self.noise.edits[k].bad)])
        parts.append(text[done:])
        return "".join(parts).split(chr(SEP))[: len(texts)], noise


# ---- training ---------------------------------------------------------------

# Words of book and chapter lines from which training headers are made, beside words of the texts themselves.
HEADER_WORDS = {"level": ["初中", "高中", "中学", "小学", "大学"], "subject": ["数学", "物理", "语文", "几何", "代数"], "kind": ["讲义", "同步", "练习册", "读本", "精讲", "教程", "课本"], "level_en": ["Junior", "Senior", "Secondary", "Primary", "Advanced"], "subject_en": ["Mathematics", "Physics", "Geometry", "Algebra"], "kind_en": ["Workbook", "Reader", "Course", "Lectures", "Practice"]}
NUMERALS = "一二三四五六七八九十"


def _header(rng: random.Random, pieces: list[str], chinese: bool) -> str:
    if chinese:
        shape = rng.random()
        if shape < 0.2:
            name = "".join(rng.choice(pieces) for _ in range(rng.choice((1, 2)))) + rng.choice((" ", "")) + f"第{rng.choice(NUMERALS)}{rng.choice('册章节编讲卷')}"
        elif shape < 0.6:
            name = "".join(rng.choice(HEADER_WORDS[k]) for k in ("level", "subject", "kind")) + " 第" + rng.choice(NUMERALS) + "册"
        else:
            name = "第" + rng.choice(NUMERALS) + "章 " + "与".join(rng.choice(pieces) for _ in range(rng.choice((1, 2, 2))))
        return "　".join(name) if rng.random() < 0.4 else name
    shape = rng.random()
    if shape < 0.2:
        name = " ".join(rng.choice(pieces).title() for _ in range(rng.randint(1, 3))) + f" {rng.choice(('Part', 'Book', 'Unit', 'Volume', 'Section'))} {rng.randint(1, 14)}"
    elif shape < 0.6:
        name = " ".join(rng.choice(HEADER_WORDS[k]) for k in ("level_en", "subject_en", "kind_en")) + f" {rng.randint(1, 6)}"
    else:
        name = f"Chapter {rng.randint(1, 14)} " + " ".join(rng.choice(pieces).title() for _ in range(rng.randint(1, 3)))
    return name.upper() if rng.random() < 0.4 else name


def _page(rng: random.Random, chinese: bool) -> str:
    n, m = rng.randint(1, 330), rng.randint(60, 400)
    forms = [f"- {n} -", f"— {n} —", f"· {n} ·", f"[{n}]", f"{n}", f"{n}", f"{n}"] + ([f"第 {n} 页", f"第{n}页 共{m}页"] if chinese else [f"Page {n}", f"Page {n} of {m}", f"p. {n}", f"{n} / {m}"])
    return rng.choice(forms)


def _wrap(text: str, width: int, chinese: bool) -> list[str]:
    if chinese:
        return [text[i : i + width] for i in range(0, len(text), width)]
    out, line = [], ""
    for word in text.split(" "):
        if line and len(line) + 1 + len(word) > width:
            out.append(line)
            line = word
        else:
            line = f"{line} {word}" if line else word
    return [*out, line]


def _surely_text(lines: list[str], k: int) -> bool:
    """Whether line ``k`` of a real text is surely none of the page."""
    x = lines[k].strip()
    return not (_marked(x) or PAGE_FORM.fullmatch(x) or _capital(x)) or (x.isdigit() and k > 0 and lines[k - 1].strip()[-1:] in set("：:"))


def _line_examples(clean: list[str], pages: list[str], rng: random.Random) -> tuple[np.ndarray, np.ndarray]:
    """Lines of wrapped clean texts with made furniture between them, and lines of real texts that are surely none; each with the operations on lines, the right one labelled 1."""
    labels = []
    chinese_of = lambda t: bool(_HAN.search(t))
    pieces, chinese = {True: [], False: []}, [chinese_of(t) for t in clean]
    for t, zh in zip(clean, chinese):
        pieces[zh] += [m[0] for m in islice(re.finditer("[一-鿿]{3,6}" if zh else r"[A-Za-z]{3,12}", t), 12)]
    made = []
    for t, zh in zip(clean, chinese):
        if len(t) < 60 or not pieces[zh]:
            continue
        lines = [(x, False) for x in _wrap(t, rng.randint(22, 48) if zh else rng.randint(36, 70), zh)]
        if rng.random() < 0.3:
            lines += [(rng.choice(("所得结果依次为：", "结果：", "答案为：") if zh else ("The result is:", "We obtain:", "Answer:")), False), (str(rng.randint(2, 900)), False)]
        if rng.random() < 0.3:
            lines += [(f"{c}{'．' if zh else '. '}{x}", False) for c, x in zip("ABCD", rng.sample(range(2, 999), 4))][: rng.randint(1, 4)] if rng.random() < 0.5 else [(rng.choice("ABCD"), False)]
        if rng.random() < 0.4:  # further paragraphs
            other = rng.choice(clean)
            lines += [("", False)] * (rng.random() < 0.6) + [(x, False) for x in _wrap(other, rng.randint(22, 48), chinese_of(other))]
        shape = rng.random()
        if shape < 0.35:
            block = [(_header(rng, pieces[zh], zh), "header")]
        elif shape < 0.65:
            block = [(_page(rng, zh), "page")]
        elif shape < 0.8:
            block = [(_header(rng, pieces[zh], zh), "header"), (_page(rng, zh), "page")]
            rng.shuffle(block)
        else:
            head, n = _header(rng, pieces[zh], zh), rng.randint(1, 330)
            block = [(f"{n}  {head}" if rng.random() < 0.5 else f"{head}  {n}", "both")]
        if rng.random() < 0.2:
            block = [("", False), *block] if rng.random() < 0.5 else [*block, ("", False)]
        where = rng.choice((0, len(lines), *range(1, len(lines)))) if len(lines) > 1 else rng.choice((0, len(lines)))
        lines[where:where] = block
        tail = " " * rng.choice((0, 0, 0, 1))
        made.append(([x + tail * (rng.random() < 0.2) for x, _ in lines], [y for _, y in lines]))
    made += [(text.split("\n"), None) for text in pages]
    codes, doc = _arrays(["\n".join(x) for x, _ in made])
    lines = Lines(codes, doc)
    if len(lines.doc) != sum(len(x) for x, _ in made):  # a sampled text held other breaks
        raise ValueError("lines and labels differ")
    first = np.concatenate([[0], np.cumsum([len(x) for x, _ in made])]).tolist()
    at = []
    candidates = np.flatnonzero(lines.candidate)
    for i, d in zip(candidates.tolist(), lines.doc[candidates].tolist()):
        own, truth = made[d]
        y = truth[i - first[d]] if truth else False
        if truth or _surely_text(own, i - first[d]):
            at.append(i)
            labels.append([1 if y == kind else -1 for kind in LINE_KINDS])
    rows, labels = features_of(lines, codes, at), np.array(labels, np.int64).reshape(-1, len(LINE_KINDS))
    return np.concatenate([of_kind(rows, kind) for kind in LINE_KINDS]), labels.T.ravel()


def _char_examples(clean: list[str], pages: list[str], rng: random.Random, noise: NoiseModel, usual: tuple[np.ndarray, np.ndarray] | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of possible edits in texts with made noise. Where a learned edit would restore the usual character of the context the text itself may be misread; unless made, such a place teaches nothing."""
    rows, labels = [], []
    texts, wrong = [], []
    codes, doc = _arrays(pages or [""])
    joined, *_ = join_lines(codes, doc, np.zeros(len(codes), bool), Averaged())
    for t in clean:
        t = re.sub(r"[\r\n]+", " ", t)
        for rate in (0.0, 0.05):
            x, edits = noise.noisy(t, rng, rate)
            texts.append(x)
            wrong.append(edits)
    raw, _ = _raw(texts)
    folded = FOLD(raw)
    # the place of each character among those that are kept
    to = np.cumsum(folded != 0) - 1
    codes, start, number = folded[folded != 0], 0, {e: k for k, e in enumerate(noise.edits)}
    bad = []
    for x, edits in zip(texts, wrong):
        bad += [(start + at, number[e]) for at, e in edits]
        start += len(x) + 1
    bad = np.array(bad, np.int64).reshape(-1, 2)
    at, edit = noise.places(codes)
    right = np.isin(at * len(number) + edit, to[bad[:, 0]] * len(number) + bad[:, 1])
    if isinstance(usual, np.ndarray):
        to = np.array([ord(e.right) if (e.bad, e.right) in noise.sure else 0 for e in noise.edits])[edit]
        sure = right | (to == 0) | ~_marked_context(_contexts(codes, at), to, usual)
        at, edit, right = at[sure], edit[sure], right[sure]
    elif len(usual[0]):
        h = _contexts(codes, at)
        slot = np.minimum(np.searchsorted(usual[0], h), len(usual[0]) - 1)
        restores = np.array([ord(e.right) if (e.bad, e.right) in noise.sure else 0 for e in noise.edits])[edit] == usual[1][slot]
        sure = right | ~(restores & (usual[0][slot] == h))
        at, edit, right = at[sure], edit[sure], right[sure]
    rows.append(around(codes, at, noise.kinds[edit], noise.more[edit]))
    labels.append(np.where(right, 1, -1))
    # texts of several lines hold other phrases. What stands in them teaches where misreadings are a small part of it
    codes = joined
    at, edit = noise.places(codes)
    whole, places = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), np.bincount(edit, minlength=len(noise.edits))
    sound = np.array([RATES[1] / 2 * whole.count(e.right) <= 0.02 * n for e, n in zip(noise.edits, places)])[edit]
    rows.append(around(codes, at[sound], noise.kinds[edit[sound]], noise.more[edit[sound]]))
    labels.append(np.full(int(sound.sum()), -1))
    at, edit = at[noise.more[edit] == 0], edit[noise.more[edit] == 0]
    cls = np.concatenate([[BREAK], CLASS[codes], [BREAK]])
    alone = (CLASS[codes[at]] == LETTER) & ~np.isin(cls[at], (LETTER, DIGIT)) & ~np.isin(cls[at + 2], (LETTER, DIGIT))
    # letters that stand alone there, such as the letter of a choice, are few beside those of words, so they count several times
    rows += [around(codes, at[alone], noise.kinds[edit[alone]])] * 3
    labels += [np.full(int(alone.sum()), -1)] * 3
    # cut words, and hyphens that are none
    cut, truth = [], []
    for t in clean:
        words = [m for m in re.finditer(r"[A-Za-z]{5,}", t)]
        if words:
            m = rng.choice(words)
            k = m.start() + rng.randint(2, len(m[0]) - 2)
            cut.append(f"{t[:k]}{rng.choice(CUT_MARKS[:3])}{' ' * rng.choice((0, 0, 1, 2))}\n{t[k:]}")
            truth.append((k, 1))
        formulas = [m for m in re.finditer(r"(?<=[a-z])-(?=[a-z])", t)]
        if formulas:
            k = rng.choice(formulas).start()
            cut.append(f"{t[: k + 1]}\n{t[k + 1 :]}")
            truth.append((k, -1))
    if cut:
        raw, _ = _raw(cut)
        folded = FOLD(raw)
        to, codes = np.cumsum(folded != 0) - 1, folded[folded != 0]
        first = np.concatenate([[0], np.cumsum([len(x) + 1 for x in cut])[:-1]])
        mark = to[first + np.array([k for k, _ in truth])]
        solid = np.flatnonzero((CLASS[codes] != BLANK) & ((CLASS[codes] != BREAK) | (codes == SEP)))
        after = solid[np.minimum(np.searchsorted(solid, mark + 1), len(solid) - 1)]
        ok = np.isin(codes[mark], CUTS) & (codes[after] != SEP)
        rows.append(_cut_features(codes, mark[ok], after[ok]))
        labels.append(np.array([y for _, y in truth])[ok])
    return np.concatenate(rows), np.concatenate(labels)


def train_editor(clean: list[str], pages: list[str], seed: int = 11, learn: bool = True) -> Editor:
    """Train on noise made in ``clean`` (texts without line breaks) and on the surely clean lines of ``pages``; ``learn``: whether the noise model learns further confusions from both."""
    clean = [t for t in clean if t and "\n" not in t and "\r" not in t]
    pages = [p for p in pages if p and "\r" not in p and chr(SEP) not in p]
    learned, usual = learn_confusions([*clean, *pages])
    noise = NoiseModel(learned if learn else ())
    return _fit(clean, pages, seed, noise, usual)


def _fit(clean: list[str], pages: list[str], seed: int, noise: NoiseModel, usual: tuple[np.ndarray, np.ndarray] | np.ndarray) -> Editor:
    rng = random.Random(seed)
    if not clean:
        return Editor(Averaged(), Averaged(), noise)
    chars = Averaged().fit(*_char_examples(clean, pages, rng, noise, usual))
    rows, labels = _line_examples(clean, pages, rng)
    return Editor(chars, Averaged().fit(rows, labels) if len(rows) else Averaged(), noise)


def _pieces(text: str) -> list[str]:
    """A text whole, or where it is very long in pieces, at line breaks where it has any; a line without one is cut by length."""
    if len(text) <= PIECE:
        return [text]
    out, size = [[]], 0
    for line in text.split("\n"):
        for x in [line[i : i + PIECE] for i in range(0, len(line), PIECE)] or [""]:
            if size + len(x) > PIECE and out[-1]:
                out.append([])
                size = 0
            out[-1].append(x)
            size += len(x) + 1
    return ["\n".join(x) for x in out]


def train_on_all(records: DataFrame, seed: int = 11) -> Editor:
    """The editor trained on all texts: confusions from the counts of all, and the mean of the weights that shards of about ``SHARD`` characters train, to one of which each text belongs by its hash."""
    spark, scratch = records.sparkSession, Scratch(records.sparkSession, "scans")
    texts = records.select("text", F.xxhash64("field", "id", "text").alias("h")).filter(F.col("text") != "")
    learned, bitmap = confusions_of(records, scratch)
    noise = NoiseModel(learned)
    sent = spark.sparkContext.broadcast((learned, bitmap))
    shards = max(1, -(-int(texts.agg(F.sum(F.length("text"))).first()[0] or 0) // SHARD))

    def train(group: pd.DataFrame) -> pd.DataFrame:
        learned, bitmap = sent.value
        pieces = [x for t in sorted(group.text) for x in _pieces(t.replace("\r\n", "\n").replace("\r", "\n").replace(chr(SEP), " "))]
        clean, pages = [x for x in pieces if x and "\n" not in x], [x for x in pieces if "\n" in x]
        usual = (np.zeros(0, np.uint64), np.zeros(0, np.uint32)) if bitmap is None else bitmap
        editor = _fit(clean, pages, seed, NoiseModel(learned), usual)
        out = []
        for model, weights in enumerate((editor.chars.w, editor.lines.w)):
            at = np.flatnonzero(weights)
            out.append(pd.DataFrame({"at": at + (model << BITS), "w": weights[at].astype(float)}))
        return pd.concat(out)

    sharded = texts.withColumn("shard", F.pmod("h", F.lit(shards))).drop("h")
    # at most one row for each weight of the two models of fixed size
    mean = sharded.groupBy("shard").applyInPandas(train, "at long, w double").groupBy("at").agg((F.sum("w") / shards).cast("float").alias("w")).toPandas()
    weights = np.zeros(2 << BITS, np.float32)
    weights[mean["at"].to_numpy()] = mean.w.to_numpy()
    return Editor(Averaged(weights[: 1 << BITS]), Averaged(weights[1 << BITS :]), noise)


def _blocks(texts: pd.Series, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, n in enumerate(texts.str.len().tolist()):
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if len(texts) > start:
        yield start, len(texts)


def scan_noise(records: DataFrame, editor: Editor | None = None) -> DataFrame:
    """(``field``, ``record_id``, ``noise``): which traces of scanning each text has, from records (``field``, ``id``, ``text``).

    Defined cases: null or empty texts have no noise; repeated rows count once; texts
    are taken whole; a text of one line has no furniture. An empty table gives an empty result.
    """
    editor = editor or train_on_all(records)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch.text.str.len() > 0]
            for a, b in _blocks(batch.text):
                part = batch.iloc[a:b]
                _, noise = editor.edit(part.text.tolist(), repair=False)
                rows = [(i, kind) for kind, docs in noise.items() for i in docs]
                if rows:
                    at = [i for i, _ in rows]
                    yield pd.DataFrame({"field": part.field.to_numpy()[at], "record_id": part.id.to_numpy()[at], "noise": [k for _, k in rows]})

    return records.select("field", F.col("id").cast("string").alias("id"), "text").filter(F.col("text").isNotNull()).mapInPandas(find, "field string, record_id string, noise string").distinct()


def repair_texts(records: DataFrame, editor: Editor | None = None) -> DataFrame:
    """``records`` with ``repaired`` (continuous paragraphs) and ``noise`` (sorted kinds found). Null stays null, with null noise."""
    editor = editor or train_on_all(records)

    @F.pandas_udf("struct<repaired: string, noise: array<string>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        out, kinds = [None] * len(texts), [None] * len(texts)
        known = np.flatnonzero(texts.notna())
        for a, b in _blocks(texts.iloc[known]):
            at = known[a:b]
            fixed, noise = editor.edit(texts.iloc[at].tolist())
            for k, i in enumerate(at):
                out[i], kinds[i] = fixed[k], sorted(x for x, docs in noise.items() if k in docs)
        return pd.DataFrame({"repaired": out, "noise": kinds})

    return records.withColumn("_edit", run("text")).withColumns({"repaired": F.col("_edit.repaired"), "noise": F.col("_edit.noise")}).drop("_edit")
