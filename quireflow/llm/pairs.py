"""Defects of prompt-response pairs: empty, refusal, copied, language, truncated.

Languages are compared by the posteriors of a naive Bayes model over character n-grams,
fitted on all labelled prompts and on short word lists for languages without labelled
prompts; a class of its own stands for alphabets that no known language has. Truncation
is judged by the likelihood that a text ends where it ends: of all places in all responses
at which the last characters of a response stand, the share that is an end; the longest
context with enough evidence decides. Empty responses, refusals and copies are found by
rules. A pair gets the first defect that holds, in the order above.

Texts are read once: a pass judges each pair by itself and writes the text forms; the
end-of-text counts are made of these, for the contexts alone of responses that no
earlier rule has decided.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..storage import Scratch
from .lookalikes import CLASS_OF, plain_form
from .scans import PAGE_FORM, _capital, _marked

# Responses without content, and labels that stand before an answer.
PLACEHOLDERS = frozenset("略 无 暂无 没有 见上 见下 同上 如上 见图 见答案 见解析 待补充 待定 空 答案略 解略 过程略 省略 null none nil n/a na nan tbd todo pending unknown omitted skip see above same as above to be added to be determined no answer".split() + ["see above", "same as above", "to be added", "to be determined", "no answer", "not available", "answer omitted", "no solution provided"])
LABELS = re.compile(r"^(?:[【\[(（]?\s*(?:参考答案|答案|解析|解答|详解|分析|证明|解|答|answers?|solutions?|explanation|proof|analysis)\s*[】\])）]?\s*[:：.。]?\s*)+", re.I)

# Words with which a reply declines, and words for what it declines.
DECLINE = re.compile(r"不能|无法|没有办法|没办法|不予|恕|不便|拒绝|不可以|难以从命|不会(?=回答|提供)|cannot|can't|can not|could not|unable|not able|decline|refuse|won't|will not|must not|not allowed|not permitted|no solution can be given|no answer can be given", re.I)
DECLINED = re.compile(r"回答|解答|提供|给出|处理|作答|代为|完成|从命|帮助|协助|满足|answer|help|assist|provide|solve|work through|request|prompt|question|exercise|discuss|respond|process|comply|continue|give", re.I)
COURTESY = re.compile(r"抱歉|对不起|遗憾|谅解|理解|感谢|谢谢|请换|自行|咨询|老师|能力范围|助手|sorry|regret|apolog|thank|understanding|assistant|something else|teacher|outside what|unfortunately|as an? ", re.I)

# Frequent words by language, for languages without labelled prompts.
SEED_WORDS = {
    "en": "the of and to a in is that for it as with be by on are at from this which or we an can has so not have its but if when one only each both what how then there these after before all any no some such find value number equation solution result sum answer first therefore equal likely piece probability follows",
    "de": "der die das und ist nicht ein eine einen mit von für auf dass wir man sich den dem als auch wird werden aus bei nach wenn oder über zahl gleichung lösung ergebnis daher zuerst danach schreiben setzen gilt sind kann durch folgt summe bedingung wert",
    "fr": "le la les des du de et est une un que qui dans pour par sur avec pas on nous donc alors sont cette ce valeur nombre équation résultat somme condition ensuite abord forme vérifie être plus ou si au aux il elle comme peut",
    "es": "el la los las de del y es una un que en por para con no se su al lo como más pero sus valor número ecuación resultado suma condición primero después luego forma cumple son esta este ha tiene entonces tanto sustituimos escribimos obtiene",
    "it": "il lo la gli le di del della e è un una che in per con non si su al come più ma valore numero equazione risultato somma condizione prima poi quindi forma sono questa questo dunque scriviamo sostituiamo",
    "pt": "o a os as de do da e é um uma que em por para com não se ao como mais mas valor número equação resultado soma condição primeiro depois portanto forma são esta este então escrevemos substituímos",
    "nl": "de het een en is niet van in op met voor dat wij men zich te zijn als ook wordt worden uit bij naar wanneer of over getal vergelijking oplossing uitkomst daarom eerst daarna schrijven waarde geldt dus som",
    "ru": "и в не на что это как по из для от мы при если то все его число уравнение ответ равен сначала затем запишем условие виде значение подставим следовательно сумма членов находится по формуле видно удовлетворяет условиям искомый поэтому",
    "ja": "の に は を た が で て と し れ さ ある いる する から こと ため です ます",
    "ko": "이 가 을 를 은 는 의 에 와 과 하다 있다 그리고 따라서 값",
}
#: Odds (natural logarithm) by which another language than the prompt's must win.
MARGIN = 9.0
#: Counts to which a language is scaled down at most, so that a large one does not know its rare n-grams better than others; what is added to each.
LARGE, ADDED = 100_000, 0.5
#: Probabilities of a letter of no known alphabet, in a known language and in another; and of any known n-gram in another.
STRANGE, OTHER_STRANGE, OTHER_KNOWN = 1e-6, 1e-3, 1e-5
#: Orders of the end-of-text model, places that a context must have, and the share of ends below which a text is cut off.
ORDERS, MIN_PLACES, END_SHARE = (10, 7, 5, 3, 2), 12, 0.04
FORMULA = re.compile(r"\$[^$]*\$?|\\[a-zA-Z]+|[A-Za-z]\([^)]*\)")
#: Bits of the bitmap of contexts: 16 for each context, within these powers of two.
LEAST_BITS, MOST_BITS = 16, 24


# ---- language ---------------------------------------------------------------


# raised, lowered and circled digits and fractions are no letters
RAISED = re.compile("[²³¹¼-¾⁰-₟⅐-↋①-⓿❶-➓]")
_CJK, _KANA, _HANGUL = re.compile("[㐀-鿿]"), re.compile("[぀-ヿ]"), re.compile("[가-힣]")


def _words(text: str) -> list[str]:
    """Words of three letters and more and CJK runs; ideographs count as one letter, as do syllables of Japanese and Korean."""
    t = RAISED.sub(" ", FORMULA.sub(" ", plain_form(text)).lower())
    if not t.isascii():
        t = _HANGUL.sub("한", _KANA.sub("か", _CJK.sub("汉", t)))
    # words without an end are read in pieces
    return [w for w in re.findall(r"[^\W\d_]{1,40}", t) if len(w) > 2 or not w.isascii()]


_GRAMS: dict[str, tuple[str, ...]] = {}


def word_grams(word: str) -> tuple[str, ...]:
    """N-grams of one to three characters of a word with its edges."""
    out = _GRAMS.get(word)
    if out is None:
        if len(_GRAMS) > 200_000:
            _GRAMS.clear()
        s = f" {word} "
        out = _GRAMS[word] = tuple(s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i : i + n] != " ")
    return out


def grams(text: str) -> Counter:
    out: Counter = Counter()
    for w in _words(text):
        out.update(word_grams(w))
    return out


OTHER = "?"
# Language tags for none, several or an unknown language.
NO_LANGUAGE = ("und", "mul", "mis", "zxx")


class LanguageModel:
    """Naive Bayes over character n-grams."""

    def __init__(self, counts: dict[str, Counter]):
        for lang, words in SEED_WORDS.items():
            seed = grams(" ".join(w + " xx" if len(w) < 3 and w.isascii() else w for w in words.split()) + " " + words)
            counts.setdefault(lang, Counter()).update({g: 40 * n for g, n in seed.items()})
        self.vocabulary = {g for c in counts.values() for g in c}
        self.weights: dict[str, dict[str, float]] = {}
        self.unseen: dict[str, float] = {}
        v = len(self.vocabulary)
        for lang, c in counts.items():
            total = sum(c.values())
            # a small sample is never scaled up: a language with few texts, such as a misspelled label, is nearly uniform and loses to one that is well known
            scale = min(1.0, LARGE / max(total, 1))
            whole = total * scale + ADDED * v
            self.weights[lang] = {g: math.log((n * scale + ADDED) / whole) for g, n in c.items()}
            self.unseen[lang] = math.log(ADDED / whole)
        self.languages = sorted(self.weights)
        self.known: dict[str, np.ndarray] = {}

    def word_scores(self, word: str) -> np.ndarray:
        """Log-likelihoods of a word by language, those of another one last. N-grams that no language has say nothing but for single letters."""
        out = self.known.get(word)
        if out is None:
            if len(self.known) > 200_000:
                self.known.clear()
            g = [x for x in word_grams(word) if x in self.vocabulary]
            strange = sum(len(x) == 1 and x not in self.vocabulary for x in word_grams(word))
            of = [sum(self.weights[k].get(x, self.unseen[k]) for x in g) + strange * math.log(STRANGE) for k in self.languages]
            out = self.known[word] = np.array([*of, len(g) * math.log(OTHER_KNOWN) + strange * math.log(OTHER_STRANGE)])
        return out

    def posteriors(self, text: str) -> dict[str, float]:
        """Logarithms of the posteriors under equal priors; empty for a text without words."""
        words = _words(text)
        if not words:
            return {}
        scores = np.sum([self.word_scores(w) for w in words], axis=0)
        return dict(zip([*self.languages, OTHER], (scores - np.logaddexp.reduce(scores)).tolist()))


def fit_languages(pairs: DataFrame, prompt: str, label: str) -> LanguageModel:
    """From all labelled prompts. Ideographs are one letter, as are syllables, so the table has at most the n-grams of a few alphabets for each label."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            words: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch["label"], batch["prompt"]):
                words[lang].update(_words(text))
            for lang, c in words.items():
                into = total[lang]
                for w, n in c.items():
                    for g in word_grams(w):
                        into[g] += n
        yield pd.DataFrame([(lang, g, n) for lang, c in total.items() for g, n in c.items()], columns=["lang", "gram", "n"])

    # the main part of a language tag; und and the like say that the language is unknown
    tag = F.regexp_extract(F.lower(F.trim(F.col(label))), r"^([^-_]*)", 1)
    known = pairs.select(tag.alias("label"), F.col(prompt).alias("prompt")).dropna().filter(~F.col("label").isin("", *NO_LANGUAGE))
    counts: dict[str, Counter] = defaultdict(Counter)
    for r in known.mapInPandas(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect():
        counts[r.lang][r.gram] = r.n
    return LanguageModel(dict(counts))


# ---- end of text ------------------------------------------------------------


def body_of(text: str) -> str:
    """The text without page furniture at its end, in one line, numbers as one digit."""
    lines = [x for x in text.replace("\r", "").split("\n")]
    while lines and (not lines[-1].strip() or (len(lines) > 1 and _page_line(lines[-1].strip()))):
        lines.pop()
    t = plain_form("\n".join(lines))
    t = re.sub(r"\s*\n\s*", " ", t).strip()
    t = re.sub(r"(?<=[⺀-鿿　-〿]) | (?=[⺀-鿿　-〿])", "", t)
    return re.sub(r"\d+(?:\.\d+)?", "0", t)


def _page_line(s: str) -> bool:
    return bool(PAGE_FORM.fullmatch(s)) or _marked(s) or (_capital(s) and s[-1:].isdigit() and not re.search(r"[=+.:：]", s))


def _end_hashes(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each order and each place with as many characters behind it: the number of the order, the hashes of these, whether the text ends there, and the number of the text."""
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    stop = np.cumsum(lens)
    doc = np.repeat(np.arange(len(texts)), lens)
    first = np.repeat(stop - lens, lens)
    at = np.arange(len(codes))
    ends = at + 1 == stop[doc] if len(codes) else np.zeros(0, bool)
    h = np.full(len(codes), 1469598103934665603, np.uint64)
    wanted = {order: k for k, order in enumerate(ORDERS)}
    with np.errstate(over="ignore"):
        # a longer context goes on with the hash of the shorter one
        for n in range(max(ORDERS)):
            ok = at - n >= first
            at, h, ends, doc, first = at[ok], h[ok], ends[ok], doc[ok], first[ok]
            h = (h ^ codes[at - n]) * np.uint64(1099511628211)
            h = h ^ (h >> np.uint64(31))
            if n + 1 in wanted:
                yield wanted[n + 1], (h ^ np.uint64(n + 1)).view(np.int64), ends, doc


def _each_block(texts: list[str], size: int = 400_000) -> Iterator[list[str]]:
    block, n = [], 0
    for t in texts:
        if n and n + len(t) > size:
            yield block
            block, n = [], 0
        block.append(t)
        n += len(t)
    if block:
        yield block


def end_shares(judged: DataFrame) -> DataFrame:
    """(id, share): of each unsure response the share of ends among all places of its longest context that stands at ``MIN_PLACES`` places or more, its own end and those of its copies left out; null if none does.

    The contexts that are asked for are first put into a bitmap, whose size is bounded
    whatever the corpus; places outside it are not shuffled.
    """
    spark = judged.sparkSession
    unsure = judged.filter("unsure").select("id", "body")
    # a response and its copies are no evidence for each other; equal bodies are counted before they are joined
    copies = unsure.groupBy(F.xxhash64("body").alias("of")).agg(F.count(F.lit(1)).alias("copies"))
    alike = lookup_join(unsure.select("id", F.xxhash64("body").alias("of")).distinct(), copies, "of", "id").select("id", "copies")

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tails = [t[-max(ORDERS) :] for t in batch.body]
            ids = batch.id.to_numpy()
            for k, h, end, doc in _end_hashes(tails):
                yield pd.DataFrame({"id": ids[doc[end]], "k": np.full(int(end.sum()), k, np.int32), "hash": h[end]})

    contexts = unsure.mapInPandas(asked, "id string, k int, hash long")
    n = unsure.count()
    power = min(MOST_BITS, max(LEAST_BITS, (16 * len(ORDERS) * max(n, 1) - 1).bit_length()))
    mask = (1 << power) - 1
    bits = np.zeros(1 << power, bool)
    bits[contexts.select(F.col("hash").bitwiseAND(F.lit(mask)).cast("int").alias("bit")).distinct().toPandas().bit.to_numpy()] = True
    packed = spark.sparkContext.broadcast(np.packbits(bits))

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.unpackbits(packed.value).view(bool)
        for batch in batches:
            for texts in _each_block(batch.body.tolist()):
                for _, h, end, _ in _end_hashes(texts):
                    ok = bits[h & mask]
                    u, inverse = np.unique(h[ok], return_inverse=True)
                    if len(u):
                        yield pd.DataFrame({"hash": u, "places": np.bincount(inverse, minlength=len(u)), "ends": np.bincount(inverse, weights=end[ok], minlength=len(u)).astype(np.int64)})

    seen = judged.filter("body != ''").select("body").mapInPandas(places, "hash long, places long, ends long").groupBy("hash").agg(F.sum("places").alias("places"), F.sum("ends").alias("ends"))
    # a context that very many responses end with is one row after counting
    looked = contexts.distinct().join(seen.filter(F.col("places") >= MIN_PLACES), "hash")
    best = looked.join(alike, "id").groupBy("id").agg(F.min_by((F.col("ends") - F.col("copies")) / F.greatest(F.col("places") - F.col("copies"), F.lit(1)), "k").alias("share"))
    return unsure.select("id").distinct().join(best, "id", "left")


#: Marks with which a sentence ends, also before closing marks.
SENTENCE_END = re.compile(r"[。！？.!?][\"'”’）)】\]]*$")


def open_formula(t: str) -> bool:
    """Whether a formula or a bracket is left open, or the last sign asks for more."""
    if t.count("$") % 2:
        return True
    if re.search(r"[=+\-×÷*/<>^_\\,，、：:;；(（\[{]$", t) or re.search(r"\\(?:frac|times|div|bar|sqrt)\s*(?:\{[^}]*\})?\$?$", t):
        return True
    return any(t.count(a) > t.count(b) for a, b in ("()", "（）", "{}", "【】"))


def complete_answer(t: str) -> bool:
    """Whether the text is a short final answer or a bare formula: one value without a sentence."""
    if re.fullmatch(r"[A-Da-d]|[-+]?0(?:\s*(?:%|[a-zA-Z]{1,3}|元|米|个|箱|人|年))?", t):
        return True
    if re.fullmatch(r"\$[^$]+\$", t):
        return True
    # a formula without signs around it, such as 3x-5>0 or f(x)=2x+1
    return len(t) <= 24 and not re.search(r"[^\W\d_]{4}|[⺀-鿿]{2}", t)


# ---- rules of single pairs --------------------------------------------------


def is_empty(text: str | None) -> bool:
    if text is None:
        return True
    t = plain_form(text).strip()
    t = LABELS.sub("", t).strip()
    core = re.sub(r"[\W_]+", "", t)
    if not core:
        # a lone sign of mathematics may be an answer
        return not re.search(r"[∅∞±√]", t)
    words = re.sub(r"[^\w/ ]+", "", t).strip().lower()
    return words in PLACEHOLDERS or core.lower() in PLACEHOLDERS


def is_refusal(text: str) -> bool:
    """Whether the sentences of a text decline to answer and nothing else stands in it."""
    t = re.sub(r"\s+", " ", plain_form(text)).strip()
    if len(t) > 400 or len(re.findall(r"\d", t)) > 6 or "=" in t:
        return False
    parts = [p for p in re.split(r"[。.!！?？;；]\s*", t) if p.strip()]
    declines = [bool(DECLINE.search(p) and DECLINED.search(p)) for p in parts]
    if not any(declines):
        return False
    rest = [p for p, d in zip(parts, declines) if not d and not COURTESY.search(p) and not DECLINE.search(p)]
    return sum(map(len, rest)) <= 12 and (declines[0] or bool(COURTESY.search(parts[0])) or bool(DECLINE.search(parts[0])) or len(parts) == 1)


def _solid(text: str) -> str:
    """Letters and digits alone, look-alikes of other scripts as the Latin letter they are drawn like."""
    return re.sub(r"[\W_]+", "", plain_form(text).translate(CLASS_OF)).lower()


def is_copied(question: str, response: str) -> bool:
    """Whether a response consists of the question or nearly all of it; counted in shared sequences of six characters."""
    q, r = _solid(question), _solid(LABELS.sub("", response.strip()))
    if len(r) < 12 or len(q) < 12:
        return bool(q) and q == r
    if q == r:
        return True
    n = 6
    of_q = {q[i : i + n] for i in range(len(q) - n + 1)}
    # characters of the response outside all shared sequences; past what the rule allows, the rest need not be looked at
    added, until, rest = 0, 0, []
    for i, c in enumerate(r):
        if r[i : i + n] in of_q:
            until = i + n
        elif i >= until:
            added += 1
            rest.append(c)
            if added > 16 and (len(r) - added) / len(r) < 0.9:
                return False
    of_r = {r[i : i + n] for i in range(len(r) - n + 1)}
    covered_q = np.zeros(len(q), bool)
    for i in range(len(q) - n + 1):
        if q[i : i + n] in of_r:
            covered_q[i : i + n] = True
    return covered_q.mean() >= 0.6 and not re.search(r"故选|因此|所以答案|解得|theansweris|weobtain", "".join(rest))


# ---- operator ---------------------------------------------------------------

SCHEMA = "id string, defect string, body string, unsure boolean"


def pair_defects(pairs: DataFrame, key: str = "question_id", prompt: str = "question_body", response: str = "solution_body", label: str = "lang") -> DataFrame:
    """(``key``, ``defect``) of every defective pair; one defect each.

    Defined cases: a null, blank or placeholder response is empty, whatever the prompt;
    a null or empty prompt has neither a language nor a copy; repeated rows count once;
    of different rows of one key each is judged, and the defect first in order counts.
    Texts are taken whole. An empty table gives an empty result.
    """
    known = pairs.select(F.col(key).cast("string").alias("id"), F.col(prompt).alias("prompt"), F.col(response).alias("response"), F.col(label).alias("lang")).filter(F.col("id").isNotNull())
    model = fit_languages(known, "prompt", "lang")
    sent = pairs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        for batch in batches:
            rows = []
            for i, q, r in zip(batch.id, batch.prompt, batch.response):
                if is_empty(r):
                    rows.append((i, "empty", None, False))
                    continue
                t, defect = body_of(r), None
                if is_refusal(r):
                    defect = "refusal"
                elif q and is_copied(q, r):
                    defect = "copied"
                elif q and _other_language(model, q, r):
                    defect = "language"
                elif not complete_answer(t) and open_formula(t):
                    defect = "truncated"
                # a text that closes with the mark of a sentence has ended its sentence
                rows.append((i, defect, t, defect is None and bool(t) and not complete_answer(t) and not SENTENCE_END.search(t)))
            yield pd.DataFrame(rows, columns=["id", "defect", "body", "unsure"])

    judged = Scratch(pairs.sparkSession, "pairs").put(known.select("id", "prompt", "response").mapInPandas(judge, SCHEMA), "judged")
    sure = judged.filter(F.col("defect").isNotNull()).select("id", "defect")
    cut = end_shares(judged).filter(F.coalesce("share", F.lit(0.0)) < END_SHARE).select("id", F.lit("truncated").alias("defect"))
    order = F.array_position(F.array(*map(F.lit, ("empty", "refusal", "copied", "language", "truncated"))), F.col("defect"))
    out = sure.union(cut).groupBy("id").agg(F.min_by("defect", order).alias("defect"))
    return out.withColumnRenamed("id", key)


def _other_language(model: LanguageModel, question: str, response: str) -> bool:
    mine, theirs = model.posteriors(question), model.posteriors(response)
    if not mine or not theirs:
        return False
    first, other = max(mine, key=mine.get), max(theirs, key=theirs.get)
    return first != other and theirs[other] - theirs[first] > MARGIN
