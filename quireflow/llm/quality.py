"""Text statistics of documents, and which documents are not prose.

A text is cut into chunks; each chunk gives partial counts and the state at its two
ends: the unfinished line and the unfinished word on either side. Two neighbouring
partials merge into one, whatever the bracketing, so the chunks of a huge document
are merged in a tree whose nodes take at most ``FAN_IN`` partials. Ratios and the
rules for lists, tables and junk come last, from the merged counts. Texts of one
chunk, nearly all, need no merge and no shuffle.

Counts are made with array operations over many chunks at once. Nothing in the rules
depends on a language: letters are those of any alphabet, and what is no language shows by
its characters, by letters without vowels (Latin alphabets alone), by capitals and digits
inside words, or by one phrase over and over.
"""

from __future__ import annotations

import unicodedata as ud
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pairs import SEED_WORDS

#: Characters of a chunk, partials that one merge takes, and levels of merges: together enough for the longest string that Spark can hold.
CHUNK, FAN_IN, LEVELS = 100_000, 64, 3
#: Characters worked on at once.
BLOCK = 400_000
#: Registers of the sketch that estimates distinct character sequences (HyperLogLog), and characters of a sequence.
REGISTERS, SEQUENCE = 2048, 6
#: Longest word that is looked up among the common ones.
LONGEST = 8

# Frequent words and characters of running text.
COMMON_WORDS = "the of and to a in is that for it as with be by on are at from this which or we an can has so not have its but if when into one only each both what who how do does was were will would may must than then there these those after before all any no some such".split()
COMMON_CJK = "的一是在不了有和人这中大为上个我以要他时来用们生到作地于出就分对成会可主发年动同工也能下过子说产种面而方后多定行学法所民得经十三之进着等部度家里如水化高自二理起小物现实加量都两体制机当使点从业本去把性好应开它合还因由其些然前外天政四日那社义事平形相全表间样与关各重新线内数正心反你明看原又么利比或但质气第向道命此变条只没结解问意建月公无系军很情者最立代想已通并提直题党程展五果料象员革位入常文总次品式活设及管特件长求老头基资边流路级少图山统接知较将组见计别她手角期根论运农指几九区强放决"  # noqa: E501
# Marks that end a sentence, that divide clauses, and that stand before an item of a list.
SENTENCE_ENDS, CLAUSE_MARKS, BULLETS = "。！？.!?…；;।؟۔።", "，,；;。！？", "-*•·●○◆■–+"
CLOSERS = "”’\"'）)】]」』"

SEP = 2
N_CODES = 0x110000

COUNTS = ["chars", "blank", "letters", "latin", "vowels", "mixed", "digits", "cjk", "common_cjk", "latin1", "bad", "percent", "symbols", "words", "common_words", "marks", "clauses"]
LINE = ["cols", "letters_cjk", "cells", "pipes", "commas", "gaps", "clauses", "words_in", "markup"]
TOTALS = ["lines", "punct_lines", "sentences", "entries", "rows", "short_lines", "entry_cols"]
STATE = ["widest_entry", "sketch", "word_head", "word_tail", "edge_head", "edge_tail"]


def _flags() -> dict[str, np.ndarray]:
    def of(chars: str = "", ranges: tuple[tuple[int, int], ...] = ()) -> np.ndarray:
        t = np.zeros(N_CODES, bool)
        for c in chars:
            t[ord(c)] = True
        for a, b in ranges:
            t[a:b] = True
        return t

    f = {
        "blank": of(" \t\n\r　\xa0\x02"),
        "letters": np.zeros(N_CODES, bool),
        "latin": of("", ((65, 91), (97, 123), (0xC0, 0xD7), (0xD8, 0xF7), (0xF8, 0x250), (0x1E00, 0x1F00))),
        "vowels": np.zeros(N_CODES, bool),
        "upper": np.zeros(N_CODES, bool),
        "digits": of("０１２３４５６７８９", ((48, 58),)),
        "cjk": of("", ((0x3400, 0xA000), (0xF900, 0xFB00), (0x20000, 0x30000))),
        "common_cjk": of(COMMON_CJK),
        "latin1": of("", ((0x80, 0x100),)),
        "bad": of("�", ((0, 9), (14, 32), (0xE000, 0xF900))),
        "percent": of("%"),
        "clauses": of(CLAUSE_MARKS),
        "pipes": of("|│┃¦｜"),
        "commas": of(",;"),
        "ends": of(SENTENCE_ENDS + "：:"),
        "closers": of(CLOSERS),
    }
    f["bad"][SEP] = False
    for code in (*range(0x3400), *range(0xA000, 0xD800), *range(0xF900, 0x20000)):
        ch = chr(code)
        f["letters"][code] = (ch.isalpha() or ud.category(ch)[0] == "M") and not f["cjk"][code]
        f["upper"][code] = ch.isupper()
    for code in np.flatnonzero(f["latin"]).tolist():
        f["vowels"][code] = ud.normalize("NFD", chr(code))[0].lower() in "aeiouæøœı"
    f["symbols"] = ~(f["blank"] | f["letters"] | f["digits"] | f["cjk"])
    return f


FLAG = _flags()
LETTERS = FLAG["letters"]
#: What stands before and behind a full stop that ends a sentence.
STOPPED = LETTERS | FLAG["cjk"]
for _c in CLOSERS + "$}%":
    STOPPED[ord(_c)] = True
GAP = FLAG["blank"]
_COMMON = frozenset(w for w in [*COMMON_WORDS, *(w for words in SEED_WORDS.values() for w in words.split())] if len(w) <= LONGEST)


def line_kind(cols: int, letters_cjk: int, cells: int, pipes: int, commas: int, gaps: int, clauses: int, words: int, markup: int, end: bool) -> tuple[int, int, int]:
    """(sentence, entry, row): which of these a line is, at most one.

    A row has table markup, bars or tabs between cells, several commas without blanks
    behind them, or several wide gaps. An entry is short (48 columns) and neither ends
    like a sentence nor has clauses. Anything else with letters is part of a sentence.
    """
    if markup or pipes >= 2 or cells >= 1 or commas >= 2 or (gaps >= 2 and not end):
        return 0, 0, 1
    if cols <= 48 and not end and clauses <= 1 and words <= 14:
        return 0, 1, 0
    return 1, 0, 0


def _blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > BLOCK:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def partials(texts: list[str]) -> list[dict]:
    """The partial of each chunk. Line features of the first and the last line are kept apart, as both may go on in a neighbour."""
    raw = np.frombuffer(chr(SEP).join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    end = np.cumsum(lens + 1) - 1
    start = end - lens
    codes = raw
    n = len(texts)
    cum = {}

    def count(name: str, flag: np.ndarray) -> np.ndarray:
        cum[name] = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return cum[name]

    flags = {k: FLAG[k][codes] for k in ("blank", "letters", "latin", "vowels", "upper", "digits", "cjk", "common_cjk", "latin1", "bad", "percent", "symbols", "clauses", "pipes", "commas", "ends", "closers")}
    before = np.concatenate([[SEP], codes[:-1]])
    after = np.concatenate([codes[1:], [SEP]])
    word_start = flags["letters"] & ~LETTERS[before]
    # text in blank columns does not count as a gap at the start of a line
    gap = flags["blank"] & (codes != 10) & (codes != SEP) & FLAG["blank"][after] & (after != 10) & (after != SEP) & ~FLAG["blank"][before]
    cell = codes == 9
    comma = flags["commas"] & (after != 32) & (after != 10) & (after != SEP)
    markup = (codes == ord("<")) & np.isin(after, (ord("t"), ord("/")))
    for k in ("blank", "letters", "latin", "vowels", "digits", "cjk", "common_cjk", "latin1", "bad", "percent", "symbols", "clauses", "pipes"):
        count(k, flags[k])
    letter_before, digit_before = LETTERS[before], FLAG["digits"][before]
    count("mixed", (flags["upper"] & letter_before & ~FLAG["upper"][before]) | (flags["letters"] & digit_before) | (flags["digits"] & letter_before))
    count("words", word_start)
    stop = (codes == 46) | (codes == 63) | (codes == 33)
    wide_stop = (codes == 0x3002) | (codes == 0xFF01) | (codes == 0xFF1F)
    dotted = stop & STOPPED[before] & GAP[after] & (after != SEP)
    count("marks", wide_stop | (dotted & (before != SEP)))
    count("cells", cell)
    count("commas", comma)
    count("gaps", gap)
    count("markup", markup)
    of = lambda k, a, b: cum[k][b] - cum[k][a]
    counts = {k: of(k, start, end) for k in COUNTS if k not in ("chars", "common_words")}
    counts["chars"] = lens
    # common words: candidates are short words, compared as strings
    text = raw.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    w0 = np.flatnonzero(word_start)
    w1 = np.flatnonzero(flags["letters"] & ~LETTERS[after]) + 1
    short = (w1 - w0) <= LONGEST
    doc_of = np.repeat(np.arange(n), lens + 1)
    hit = np.fromiter((text[a:b].lower() in _COMMON for a, b in zip(w0[short].tolist(), w1[short].tolist())), bool, int(short.sum()))
    a_short = w0[short]
    inner = (a_short > start[doc_of[a_short]]) & (w1[short] < end[doc_of[a_short]])
    counts["common_words"] = np.bincount(doc_of[a_short[hit & inner]], minlength=n)
    # lines: of the whole block, then first and last of each chunk
    brk = np.flatnonzero((codes == 10) | (codes == SEP))
    l0 = np.concatenate([[0], brk[:-1] + 1])
    solid = np.maximum.accumulate(np.where(flags["blank"] | flags["closers"], -1, np.arange(len(codes))))
    any_solid = np.maximum.accumulate(np.where(flags["blank"], -1, np.arange(len(codes))))
    last = solid[np.maximum(brk - 1, 0)]
    ends = (last >= l0) & flags["ends"][np.maximum(last, 0)]
    full = (any_solid[np.maximum(brk - 1, 0)] >= l0) & (brk > l0)
    line = {"letters_cjk": of("letters", l0, brk) + of("cjk", l0, brk), "cols": (brk - l0) + of("cjk", l0, brk), "cells": of("cells", l0, brk), "pipes": of("pipes", l0, brk), "commas": of("commas", l0, brk), "gaps": of("gaps", l0, brk), "clauses": of("clauses", l0, brk), "words_in": of("words", l0, brk) + of("cjk", l0, brk) // 2, "markup": of("markup", l0, brk)}
    line_doc = doc_of[brk]
    first = np.concatenate([[True], line_doc[1:] != line_doc[:-1]])
    final = codes[brk] == SEP
    mid = ~first & ~final & full
    row = (line["markup"] > 0) | (line["pipes"] >= 2) | (line["cells"] >= 1) | (line["commas"] >= 2) | ((line["gaps"] >= 2) & ~ends)
    entry = ~row & (line["cols"] <= 48) & ~ends & (line["clauses"] <= 1) & (line["words_in"] <= 14)
    sums = {"lines": mid, "punct_lines": mid & ends, "sentences": mid & ~row & ~entry, "entries": mid & entry, "rows": mid & row, "short_lines": mid & (line["cols"] <= 48)}
    totals = {k: np.bincount(line_doc[v], minlength=n) for k, v in sums.items()}
    of_entries = mid & entry
    totals["entry_cols"] = np.bincount(line_doc[of_entries], weights=line["cols"][of_entries], minlength=n).astype(np.int64)
    widest = np.zeros(n, np.int64)
    np.maximum.at(widest, line_doc[of_entries], line["cols"][of_entries])
    # distinct sequences of six characters
    sketch = np.zeros((n, REGISTERS), np.uint8)
    if len(codes) >= SEQUENCE:
        at, rank, ok = _ranks(codes)
        np.maximum.at(sketch.reshape(-1), doc_of[: len(ok)][ok] * REGISTERS + at[ok], rank[ok])
    heads, tails = np.flatnonzero(first), np.flatnonzero(final)
    out = []
    as_list = {k: v.tolist() for k, v in (counts | totals).items()}
    line_list = {k: (v[heads].tolist(), v[tails].tolist()) for k, v in line.items()}
    ends_head, ends_tail, full_head, full_tail = ends[heads].tolist(), ends[tails].tolist(), full[heads].tolist(), full[tails].tolist()
    for i, t in enumerate(texts):
        p = {k: v[i] for k, v in as_list.items()}
        p["head"] = {k: v[0][i] for k, v in line_list.items()} | {"end": ends_head[i], "full": full_head[i]}
        p["tail"] = {k: v[1][i] for k, v in line_list.items()} | {"end": ends_tail[i], "full": full_tail[i]} if heads[i] != tails[i] else None
        p["sketch"], p["widest_entry"], p["edge_head"], p["edge_tail"] = sketch[i].tobytes(), int(widest[i]), t[: SEQUENCE - 1], t[1 - SEQUENCE :]
        p["word_head"], p["word_tail"] = _end_words(t)
        out.append(p)
    return out


def _ranks(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the sequence that begins at each place: its register, its rank there, and whether it lies within one chunk."""
    n = len(codes) - SEQUENCE + 1
    h, ok = np.zeros(n, np.uint64), np.ones(n, bool)
    with np.errstate(over="ignore"):
        for k in range(SEQUENCE):
            c = codes[k : k + n]
            h = (h ^ c) * np.uint64(1099511628211)
            ok &= c != SEP
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    rest = (h & np.uint64(0xFFFFFFFF)).astype(np.float64)
    rank = np.where(rest > 0, 32 - np.floor(np.log2(np.maximum(rest, 1))), 33).astype(np.uint8)
    return (h >> np.uint64(53)).astype(np.int64), rank, ok


def _distinct(sketch: np.ndarray) -> float:
    zeros = int((sketch == 0).sum())
    raw = 0.7213 / (1 + 1.079 / REGISTERS) * REGISTERS**2 / float(np.ldexp(1.0, -sketch.astype(np.int32)).sum())
    return REGISTERS * float(np.log(REGISTERS / zeros)) if zeros and raw <= 2.5 * REGISTERS else raw


def _end_words(t: str) -> tuple[str, str | None]:
    """The letters that a chunk begins and ends with; the second is None where the chunk is one word. Words over 32 letters are cut, they are no common words."""
    a = 0
    while a < len(t) and LETTERS[ord(t[a])]:
        a += 1
    if a == len(t):
        return t[:33], None
    b = len(t)
    while b > a and LETTERS[ord(t[b - 1])]:
        b -= 1
    return t[:a][:33], t[b:][:33]


def _add_line(p: dict, x: dict) -> None:
    if not x["full"]:
        return
    s, e, r = line_kind(x["cols"], x["letters_cjk"], x["cells"], x["pipes"], x["commas"], x["gaps"], x["clauses"], x["words_in"], x["markup"], x["end"])
    p["lines"] += 1
    p["punct_lines"] += bool(x["end"])
    p["sentences"] += s
    p["entries"] += e
    if e:
        p["entry_cols"] += x["cols"]
        p["widest_entry"] = max(p["widest_entry"], x["cols"])
    p["rows"] += r
    p["short_lines"] += x["cols"] <= 48


def merge(a: dict, b: dict) -> dict:
    """The partial of two neighbouring chunks; associative."""
    p = {k: a[k] + b[k] for k in COUNTS + TOTALS}
    p["widest_entry"] = max(a["widest_entry"], b["widest_entry"])
    edge = SEQUENCE - 1
    p["edge_head"], p["edge_tail"] = (a["edge_head"] + (b["edge_head"] if a["chars"] < edge else ""))[:edge], ((a["edge_tail"] if b["chars"] < edge else "") + b["edge_tail"])[-edge:]
    p["mixed"] += _mixed(a["edge_tail"][-1:], b["edge_head"][:1])
    # a full stop at the cut was not counted, as what stands before or behind it was unknown
    p["marks"] += _stops(a["edge_tail"][-2:], b["edge_head"][:2])
    # a word that runs over the cut was counted on both sides
    left = a["word_head"] if a["word_tail"] is None else a["word_tail"]
    right = b["word_head"]
    if left and right:
        p["words"] -= 1
    word = (left + right)[:33]
    a_one, b_one = a["word_tail"] is None, b["word_tail"] is None
    if not a_one and not b_one and word.lower() in _COMMON:
        p["common_words"] += 1
    p["word_head"] = word if a_one else a["word_head"]
    p["word_tail"] = None if a_one and b_one else (word if b_one else b["word_tail"])
    seam = a["tail"] or a["head"]
    joined = {k: seam[k] + b["head"][k] for k in LINE} | {"end": b["head"]["end"] if b["head"]["full"] else seam["end"], "full": seam["full"] or b["head"]["full"]}
    if a["tail"] is None and b["tail"] is None:
        p["head"], p["tail"] = joined, None
    elif a["tail"] is None:
        p["head"], p["tail"] = joined, b["tail"]
    elif b["tail"] is None:
        p["head"], p["tail"] = a["head"], joined
    else:
        p["head"], p["tail"] = a["head"], b["tail"]
        _add_line(p, joined)
    sketch = np.maximum(np.frombuffer(a["sketch"], np.uint8), np.frombuffer(b["sketch"], np.uint8))
    # sequences over the cut
    seam = np.array([ord(c) for c in a["edge_tail"] + b["edge_head"]], np.uint32)
    if len(seam) >= SEQUENCE:
        at, rank, ok = _ranks(seam)
        np.maximum.at(sketch, at[ok], rank[ok])
    p["sketch"] = sketch.tobytes()
    return p


def _mixed(left: str, right: str) -> int:
    if not left or not right:
        return 0
    a, b = ord(left), ord(right)
    return int((FLAG["upper"][b] and LETTERS[a] and not FLAG["upper"][a]) or (LETTERS[b] and FLAG["digits"][a]) or (FLAG["digits"][b] and LETTERS[a]))


def _stops(left: str, right: str) -> int:
    """Full stops in two edges whose surroundings only both sides together show."""
    t, n = left + right, 0
    for i in {len(left) - 1, len(left)}:
        if 0 < i < len(t) - 1 and t[i] in ".?!" and STOPPED[ord(t[i - 1])] and GAP[ord(t[i + 1])]:
            n += 1
    return n


STATS = "n_chars long, n_lines long, n_words long, mean_word_length double, symbol_ratio double, digit_ratio double, punct_line_share double, common_share double, repeat_share double, form string"


def finish(p: dict) -> dict:
    """Ratios and form of a whole text."""
    p = dict(p)
    for x in (p["head"], p["tail"]):
        if x is not None:
            _add_line(p, x)
    ends = {p["word_head"], p["word_tail"]} - {"", None} if p["word_tail"] is None else [w for w in (p["word_head"], p["word_tail"]) if w]
    p["common_words"] += sum(w.lower() in _COMMON for w in ends)
    solid = max(1, p["chars"] - p["blank"])
    words = p["words"] + p["cjk"]
    grams = max(1, p["chars"] - SEQUENCE + 1)
    repeat = 1 - min(1.0, _distinct(np.frombuffer(p["sketch"], np.uint8)) / grams)
    common = (p["common_words"] + p["common_cjk"]) / max(1, words)
    return {
        "n_chars": p["chars"], "n_lines": p["lines"], "n_words": words, "mean_word_length": p["letters"] / p["words"] if p["words"] else 0.0,
        "symbol_ratio": p["symbols"] / solid, "digit_ratio": p["digits"] / solid, "punct_line_share": p["punct_lines"] / max(1, p["lines"]),
        "common_share": common, "repeat_share": float(repeat), "form": form_of(p, solid, repeat),
    }


def form_of(p: dict, solid: int, repeat: float) -> str:
    """prose, list, table or junk. Every rule looks at the larger part of the text, so that a leading sentence changes nothing."""
    if solid < 2:
        return "junk" if p["chars"] > 0 else "prose"
    if p["bad"] / solid > 0.08 or p["latin1"] / solid > 0.2 or p["percent"] / solid > 0.12:
        return "junk"
    if repeat > 0.8 and p["chars"] >= 60:
        return "junk"
    lines = max(1, p["lines"])
    if lines >= 3 and p["rows"] / lines > 0.5:
        return "table"
    if lines >= 3 and p["entries"] / lines > 0.5 and not _wrapped(p, lines):
        return "list"
    readable = p["letters"] + p["cjk"]
    if readable / solid < 0.35:
        return "junk"
    latin, others = p["latin"], p["letters"] - p["latin"] + p["cjk"]
    if latin > 1.5 * others and p["vowels"] / max(1, latin) < 0.27:
        return "junk"
    if p["mixed"] / solid > 0.15:
        return "junk"
    return "prose"


def _wrapped(p: dict, lines: int) -> bool:
    """Whether the short lines are those of wrapped prose: sentences end inside them, or all are about as wide as a narrow column."""
    mean = p["entry_cols"] / max(1, p["entries"])
    even = mean / max(1, p["widest_entry"])
    return (p["marks"] - 1) / lines >= 0.15 or (even >= 0.85 and mean >= 38) or (even >= 0.8 and mean >= 30 and p["clauses"] / lines >= 0.4 and p["marks"] > 1)


def _flat(p: dict) -> tuple:
    line = lambda x: [*(int(x[k]) for k in LINE), int(x["end"]), int(x["full"])] if x else None
    return (*(int(p[k]) for k in COUNTS + TOTALS), line(p["head"]), line(p["tail"]), *(p[k] for k in STATE))


def _unflat(r: tuple) -> dict:
    n = len(COUNTS) + len(TOTALS)
    line = lambda x: {k: int(v) for k, v in zip(LINE, x)} | {"end": bool(x[-2]), "full": bool(x[-1])} if x is not None else None
    return dict(zip(COUNTS + TOTALS, r[:n])) | {"head": line(r[n]), "tail": line(r[n + 1])} | dict(zip(STATE, r[n + 2 :]))


PARTIAL = ", ".join(f"{k} long" for k in COUNTS + TOTALS) + ", head array<int>, tail array<int>, widest_entry long, sketch binary, word_head string, word_tail string, edge_head string, edge_tail string"
PARTIAL_COLUMNS = COUNTS + TOTALS + ["head", "tail", *STATE]


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the statistics of each document, see ``STATS``; ``form`` is prose, list, table or junk.

    Defined cases: a null text has no row; an empty one has zeros and the form prose, one
    of nothing but blanks the form junk; repeated rows give repeated rows; texts are taken
    whole, of any length; other columns are ignored, whatever their names.
    """
    kind = docs.schema[key].dataType.simpleString()
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    schema = f"key {kind}, {STATS}"

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in _blocks(batch.text.str.len().to_numpy()):
                part = batch.iloc[a:b]
                yield pd.DataFrame([finish(p) for p in partials(part.text.tolist())]).assign(key=part.key.to_numpy())[[c.split()[0] for c in schema.split(", ")]]

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in _blocks(batch.text.str.len().to_numpy()):
                part = batch.iloc[a:b]
                yield pd.DataFrame([_flat(p) for p in partials(part.text.tolist())], columns=PARTIAL_COLUMNS).assign(id=part.id.to_numpy(), key=part.key.to_numpy(), at=part["at"].to_numpy())[["id", "key", "at", *PARTIAL_COLUMNS]]

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at")
        whole = None
        for r in group[PARTIAL_COLUMNS].itertuples(index=False, name=None):
            whole = _unflat(r) if whole is None else merge(whole, _unflat(r))
        return pd.DataFrame([_flat(whole)], columns=PARTIAL_COLUMNS).assign(id=group.id.iloc[0], key=group.key.iloc[0], at=int(group["at"].iloc[0]) // FAN_IN)[["id", "key", "at", *PARTIAL_COLUMNS]]

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [finish(_unflat(r)) for r in batch[PARTIAL_COLUMNS].itertuples(index=False, name=None)]
            if rows:
                yield pd.DataFrame(rows).assign(key=batch.key.to_numpy())[[c.split()[0] for c in schema.split(", ")]]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i, k, t in zip(batch.id, batch.key, batch.text):
                for a in range(0, len(t), 16 * CHUNK):
                    part = [t[b : b + CHUNK] for b in range(a, min(len(t), a + 16 * CHUNK), CHUNK)]
                    yield pd.DataFrame({"id": [i] * len(part), "key": [k] * len(part), "at": np.arange(len(part), dtype=np.int32) + a // CHUNK, "text": part})

    few = docs.filter(F.length("text") <= CHUNK).mapInPandas(short, schema)
    many = docs.filter(F.length("text") > CHUNK).withColumn("id", F.concat_ws("-", F.col("key").cast("string"), F.monotonically_increasing_id()))
    # a huge text is cut in one pass, and its chunks are spread over tasks
    many = many.select("id", "key", "text").mapInPandas(pieces, f"id string, key {kind}, at int, text string").repartition("id", "at").mapInPandas(chunks, f"id string, key {kind}, at int, {PARTIAL}")
    for _ in range(LEVELS):
        many = many.groupBy("id", F.floor(F.col("at") / FAN_IN).alias("node")).applyInPandas(lambda _, g: fold(g), f"id string, key {kind}, at int, {PARTIAL}")
    return few.union(many.mapInPandas(last, schema)).withColumnRenamed("key", key)


def not_prose(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``form``) of the documents that are list, table or junk."""
    return text_statistics(docs, key, text).filter("form != 'prose'").select(key, "form")
