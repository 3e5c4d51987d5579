"""One consistent form for texts that look the same.

Three steps. (1) Characters that only differ in width or presentation are replaced
by their plain form, ignorable ones are deleted, blanks of any width become one
kind of blank. Raised, lowered and circled forms and fractions stay what they are.
(2) In each run of Latin, Greek and Cyrillic letters every letter stands for its class of
look-alikes; the lattice of all their spellings is searched by Viterbi for the
spelling that is most likely under character bigrams counted within scripts, with
a penalty for each change of script. (3) Accents are composed again.

The lattice of a token is a function of its classes alone, and the classes are
disjoint; so two tokens get the same spelling exactly if they look the same.
"""

from __future__ import annotations

import math
import re
import unicodedata as ud
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import HOT_ROWS, lookup_join
from ..storage import Scratch

# Letters of other scripts that are drawn like a Latin one.
LOOK_ALIKES = {
    "A": "ΑА", "B": "ΒВ", "C": "ϹС", "E": "ΕЕ", "G": "Ԍ", "H": "ΗН", "I": "ΙІӀ", "J": "ͿЈ", "K": "ΚК", "M": "ΜМ", "N": "Ν", "O": "ΟО", "P": "ΡР",
    "Q": "Ԛ", "S": "Ѕ", "T": "ΤТ", "W": "Ԝ", "X": "ΧХ", "Y": "ΥУҮ", "Z": "Ζ", "a": "а", "c": "ϲс", "d": "ԁ", "e": "е", "h": "һ", "i": "і", "j": "ϳј", "l": "ӏ",
    "o": "οо", "p": "р", "q": "ԛ", "s": "ѕ", "v": "νѵ", "w": "ԝ", "x": "х", "y": "уү",
}
# CJK radicals without a decomposition of their own, and the character drawn like them.
RADICALS = dict(zip("⺁⺎⺝⺟⺠⺬⺮⻁⻄⻅⻆⻉⻋⻓⻔⻘⻙⻚⻛⻜⻝⻢⻣⻤⻥⻦⻧⻨⻩⻬⻮⻰⻳", "厂兀月母民示竹虎西见角贝车长门青韦页风飞食马骨鬼鱼鸟卤麦黄齐齿龙龟", strict=True))
# Forms of a dash of the width of a hyphen.
HYPHENS = "‐‑‒−﹣－"
# Tags of decompositions that change what is read.
READ_DIFFERENTLY = ("<super>", "<sub>", "<circle>", "<fraction>")

CLASS_OF = {ord(x): k for k, xs in LOOK_ALIKES.items() for x in xs}
TOKEN = re.compile("[A-Za-z̀-ͯͰ-ϿЀ-ԯ]+")
START = "^"
#: Natural logarithm of the odds against a change of script inside a token.
SWITCH = 12.0


class _Plain(dict):
    """Code point -> plain form, filled as characters are met."""

    def __missing__(self, code: int) -> str | None:
        self[code] = out = self._plain(chr(code))
        return out

    def _plain(self, ch: str) -> str | None:
        code = ord(ch)
        if code < 0x80:
            return " " if ch == "\t" else ch
        if ud.category(ch) == "Cf" or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF or code in (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0):
            return None
        if ud.category(ch) == "Zs":
            return " "
        if ch in HYPHENS:
            return "-"
        if ch in RADICALS:
            return RADICALS[ch]
        parts = ud.decomposition(ch).split()
        if not parts:
            return ch
        if parts[0].startswith("<"):
            # a spacing accent would fall apart into a blank and an accent; a long s is another letter
            if parts[0] in READ_DIFFERENTLY or parts[1] == "0020" or ch == "ſ":
                return ch
            parts = parts[1:]
        return "".join(self._plain(chr(int(p, 16))) or "" for p in parts)


PLAIN = _Plain()


def plain_form(text: str) -> str:
    """Steps (1): plain widths and forms, no ignorable characters, letters and accents apart."""
    text = text.translate(PLAIN)
    return text if text.isascii() else ud.normalize("NFD", text)


def script_of(ch: str) -> str:
    return "L" if ch < "̀" else "G" if ch < "Ѐ" else "C"


def count_bigrams(texts: Iterator[str]) -> Counter:
    """(previous, letter) counts over the tokens written in one script; accents are skipped."""
    out: Counter = Counter()
    for text in texts:
        for token in TOKEN.findall(plain_form(text)):
            letters = [c for c in token if not "̀" <= c <= "ͯ"]
            if letters and len({script_of(c) for c in letters}) == 1:
                out.update(zip([START, *letters], letters))
    return out


class TokenSpeller:
    """The best spelling of a token's lattice of look-alikes; spellings are kept by skeleton."""

    def __init__(self, bigrams: dict[tuple[str, str], int], keep: int = 200_000):
        self.bigrams, self.keep = bigrams, keep
        self.after: Counter = Counter()
        for (a, _), n in bigrams.items():
            self.after[a] += n
        self.found: dict[str, str] = {}

    def _score(self, a: str, b: str) -> float:
        if a != START and script_of(a) != script_of(b):
            return -SWITCH + math.log((self.bigrams.get((START, b), 0) + 0.5) / (self.after[START] + 50))
        return math.log((self.bigrams.get((a, b), 0) + 0.5) / (self.after[a] + 50))

    def _viterbi(self, skeleton: str) -> str:
        paths = {START: (0.0, "")}
        for c in skeleton:
            if "̀" <= c <= "ͯ":
                paths = {a: (s, t + c) for a, (s, t) in paths.items()}
                continue
            # ties go to the first spelling in the order Latin, Greek, Cyrillic
            paths = {b: max(((s + self._score(a, b), t + b) for a, (s, t) in paths.items()), key=lambda x: x[0]) for b in c + LOOK_ALIKES.get(c, "")}
        return max(paths.values(), key=lambda x: x[0])[1]

    def spell(self, token: str) -> str:
        skeleton = token.translate(CLASS_OF)
        out = self.found.get(skeleton)
        if out is None:
            if len(self.found) >= self.keep:
                self.found.clear()
            out = self.found[skeleton] = self._viterbi(skeleton)
        return out

    def text(self, text: str) -> str:
        out = TOKEN.sub(lambda m: self.spell(m[0]), plain_form(text))
        return out if out.isascii() else ud.normalize("NFC", out)


def fit_bigrams(texts: DataFrame, column: str) -> dict[tuple[str, str], int]:
    """Bigram counts over all texts. The table has at most one row for each pair of letters of three alphabets, which bounds what the driver gets."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            total.update(count_bigrams(batch[column].dropna()))
        yield pd.DataFrame([(a, b, n) for (a, b), n in total.items()], columns=["a", "b", "n"])

    rows = texts.select(column).mapInPandas(count, "a string, b string, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    return {(r.a, r.b): r.n for r in rows}


def consistent_form(bigrams: dict[tuple[str, str], int]):
    """A column function: text -> its consistent form; null stays null."""
    speller: list[TokenSpeller] = []

    @F.pandas_udf("string")
    def udf(texts: pd.Series) -> pd.Series:
        if not speller:
            speller.append(TokenSpeller(bigrams))
        return texts.map(speller[0].text, na_action="ignore")

    return udf


def normalize_texts(df: DataFrame, column: str, out: str = "consistent", bigrams: dict[tuple[str, str], int] | None = None) -> DataFrame:
    """``df`` with the consistent form of ``column`` in ``out``.

    Defined cases: null stays null and an empty text empty; texts of any length are
    taken whole; line breaks stay. Bigrams are counted over the whole column unless given.
    """
    bigrams = fit_bigrams(df, column) if bigrams is None else bigrams
    return df.withColumn(out, consistent_form(bigrams)(F.col(column)))


def _digest(c: Column | str) -> Column:
    return F.unhex(F.sha2(F.col(c) if isinstance(c, str) else c, 256))


def _forms(records: DataFrame, bigrams: dict[tuple[str, str], int] | None) -> DataFrame:
    """(field, scope, id, raw, form): digests of every text and of its consistent form; written once, as both sides of a join read it."""
    known = records.select("field", "scope", F.col("id").cast("string").alias("id"), "text").dropna()
    bigrams = fit_bigrams(known, "text") if bigrams is None else bigrams
    return Scratch(records.sparkSession, "forms").put(known.select("field", "scope", "id", _digest("text").alias("raw"), _digest(consistent_form(bigrams)(F.col("text"))).alias("form")).distinct(), "forms")


def same_looking_classes(records: DataFrame, bigrams: dict[tuple[str, str], int] | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(``field``, ``id``, ``class_id``, ``records``, ``spellings``): of each record the least id of those of its field and scope whose texts look the same, their number, and whether they differ in their characters (2) or not (1).

    One row for each record whatever the size of a class; a class that very many records
    share is counted before the join. Null field, scope, id or text has no row; repeated
    rows count once; of different texts of one id each has a row.
    """
    forms = _forms(records, bigrams).withColumn("at", F.struct("field", "scope", "form"))
    classes = forms.groupBy("at").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("records"), F.when(F.min("raw") == F.max("raw"), 1).otherwise(2).alias("spellings"))
    return lookup_join(forms.select("field", "id", "at"), classes, "at", "id", hot_rows=hot_rows).select("field", "id", "class_id", "records", "spellings").distinct()


def same_looking_pairs(records: DataFrame, bigrams: dict[tuple[str, str], int] | None = None, block: int = 2_000) -> DataFrame:
    """Pairs of records whose texts look the same but differ in their characters.

    ``records`` has ``field``, ``scope``, ``id``, ``text``; pairs are formed within field
    and scope. Returns distinct (``field``, ``left_id``, ``right_id``), left before right.
    Texts are compared by SHA-256 of raw and consistent form. Groups in which all texts
    are equal are dropped before the join; the rest of a group is joined in blocks of
    ``block`` records, so that a very large group is no task of its own.

    Defined cases: null field, scope, id or text forms no pair; repeated rows count once;
    an id is not paired with itself.
    """
    forms = _forms(records, bigrams)
    group = ["field", "scope", "form"]
    uneven = forms.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("a"), F.max("raw").alias("b")).filter("a != b").select(*group, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    rows = forms.join(uneven, group)
    left = rows.withColumn("at", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).select(*group, "at", F.col("id").alias("left_id"), F.col("raw").alias("left_raw"))
    right = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*group, "at", F.col("id").alias("right_id"), F.col("raw").alias("right_raw"))
    return left.join(right, [*group, "at"]).filter((F.col("left_id") < F.col("right_id")) & (F.col("left_raw") != F.col("right_raw"))).select("field", "left_id", "right_id").distinct()
