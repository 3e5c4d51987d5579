"""Text functions as column expressions; they stay in the JVM and in generated code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names that a Windows file system reserves.
RESERVED_NAMES = ("CON", "PRN", "AUX", "NUL", *(f"COM{i}" for i in range(1, 10)), *(f"LPT{i}" for i in range(1, 10)))
MARKERS = r"(?i)^\s*(?:[-*+]|>|#{1,6})\s+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line, text): the numbered lines of each text, from 1; null texts have none, an empty text has one empty line."""
    return df.select(key, F.posexplode(F.split(F.col(text), "\n", -1)).alias("at", "line_text")).select(key, (F.col("at") + 1).alias("line"), F.col("line_text").alias("text"))


def compact(c: Column | str) -> Column:
    """Lower case without white space."""
    return F.lower(F.regexp_replace(col(c), r"(?U)\s+", ""))


def stem(c: Column | str, size: int = 240) -> Column:
    """The first letters, digits and ideographs of a text, in lower case."""
    return F.substring(F.lower(F.regexp_replace(col(c), r"(?U)[^\p{L}\p{N}]+", "")), 1, size)


def plain_math(c: Column | str) -> Column:
    """Without font macros, dollar signs, braces, underscores and blanks, in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(col(c), r"\\(?:mathrm|mathbf|mathit|rm|bf|it|text|displaystyle)(?![A-Za-z])", ""), r"[${}_ ]", ""))


def unify_latex(c: Column | str) -> Column:
    """Variants of fractions, relations and operators as one, without blanks."""
    out = col(c)
    for pattern, to in ((r"\\[dt]frac", r"\\frac"), (r"\\(?:leqslant|leq|le)(?![a-zA-Z])", r"\\le "), (r"\\(?:geqslant|geq|ge)(?![a-zA-Z])", r"\\ge "), (r"\\left|\\right|\\displaystyle", ""), (r"\s+", "")):
        out = F.regexp_replace(out, pattern, to)
    return out


def lengthen_fractions(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"\\frac(?![a-zA-Z])", r"\\dfrac")


def ngrams(c: Column | str, width: int = 2) -> Column:
    """The set of character n-grams; a shorter text is its own only one, an empty one has none."""
    t = col(c)
    n = F.length(t)
    grams = F.transform(F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1))), lambda i: F.substring(t, i, F.lit(width)))
    return F.when(n == 0, F.array().cast("array<string>")).when(n <= width, F.array(t)).when(n > width, F.array_distinct(grams))


def jaccard(a: Column, b: Column) -> Column:
    """Shared part of two sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def containment(a: Column, b: Column) -> Column:
    """Part of ``a`` that is in ``b``; an empty ``a`` is contained in an empty ``b`` only."""
    return F.when(F.size(a) == 0, F.when(F.size(b) == 0, 1.0).otherwise(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vectors; 0 for empty ones, different lengths and zero norms."""
    a, b = col(a), col(b)
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == 0) | (F.size(a) != F.size(b)) | (norm == 0), F.lit(0.0)).otherwise(dot(a, b) / norm)


def stable_key(prefix: str, *parts: Column | str) -> Column:
    """The prefix and 16 hexadecimal digits of the digest of all parts; null parts count as empty."""
    joined = F.concat_ws("\x1f", *[F.coalesce(col(p).cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, 16))


def pair_key(prefix: str, a: Column | str, b: Column | str) -> Column:
    """The same key for either order of a pair."""
    return stable_key(prefix, F.least(col(a), col(b)), F.greatest(col(a), col(b)))


def compact_title(c: Column | str, low: int = 10, high: int = 34) -> Column:
    """A long title cut behind the first clause that ends between ``low`` and ``high``, else cut off with an ellipsis."""
    t = F.trim(col(c))
    head = F.regexp_extract(t, rf"^(.{{{low},{high}}}?)[，。；：,;:]", 1)
    return F.when(F.length(t) <= high, t).when(head != "", head).otherwise(F.concat(F.substring(t, 1, high - 1), F.lit("…")))


def safe_name(c: Column | str, size: int = 36) -> Column:
    """A name of letters and digits with underlines between, cut to ``size``; never empty."""
    t = F.regexp_replace(F.regexp_replace(col(c), r"(?U)[^\p{L}\p{N}]+", "_"), r"^_+|_+$", "")
    return F.when(t == "", F.lit("unnamed")).otherwise(F.substring(t, 1, size))


def sanitize_file_name(c: Column | str) -> Column:
    """A name that every file system takes: no reserved characters, control characters, dots or blanks at the end, or reserved names."""
    t = F.regexp_replace(F.regexp_replace(col(c), r'[<>:"/\\|?*\x00-\x1f]', "_"), r"[. ]+$", "")
    bare = F.upper(F.regexp_extract(t, r"^([^.]*)", 1))
    return F.when(t == "", F.lit("_")).when(bare.isin(*RESERVED_NAMES), F.concat(F.lit("_"), t)).otherwise(t)


def strip_frontmatter(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?s)\A---\n.*?\n---\n?", "")


def strip_fences(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(?sm)^(`{3,}|~{3,}).*?^\1\s*?$\n?", "")


def link_targets(c: Column | str) -> Column:
    """Local targets of links and images in order; addresses and anchors are left out."""
    found = F.regexp_extract_all(strip_fences(c), F.lit(r"!?\[[^\]]*\]\(([^)\s]+)\)"), 1)
    return F.filter(found, lambda x: ~x.rlike(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:|#|//)"))


def embed_targets(c: Column | str) -> Column:
    """Targets of embeds without alias and anchor."""
    return F.transform(F.regexp_extract_all(strip_fences(c), F.lit(r"!\[\[([^\]]+)\]\]"), 1), lambda x: F.trim(F.regexp_extract(x, r"^([^#|]*)", 1)))


def standard_layout(c: Column | str) -> Column:
    """Unix line ends, no blanks at line ends, at most two blank lines."""
    t = F.regexp_replace(F.regexp_replace(col(c), r"\r\n?", "\n"), r"[ \t]+(?=\n|\z)", "")
    return F.regexp_replace(t, r"\n{4,}", "\n\n\n")


def body_words(c: Column | str) -> Column:
    """Text without images, links, wiki links, headings and line marks, in lower case and without white space."""
    t = F.regexp_replace(col(c), r"!\[[^\]]*\]\([^)]*\)|!\[\[[^\]]*\]\]", "")
    t = F.regexp_replace(t, r"\[([^\]]*)\]\([^)]*\)", "$1")
    t = F.regexp_replace(t, r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1")
    return compact(F.regexp_replace(t, r"(?m)^\s*(?:#{1,6}[^\n]*|>\s*|[-*+]\s+|\d+[.)]\s+)", ""))


def visible_length(c: Column | str) -> Column:
    """Characters without images, tags and white space."""
    return F.length(F.regexp_replace(col(c), r"(?U)!\[[^\]]*\]\([^)]*\)|<[^>]+>|\s+", ""))


def tag_balance(c: Column | str, tag: str) -> Column:
    """Opening minus closing tags."""
    return F.regexp_count(col(c), F.lit(rf"(?i)<{tag}[\s>]")) - F.regexp_count(col(c), F.lit(rf"(?i)</{tag}\s*>"))


def spaced_digits(c: Column | str) -> Column:
    """Formulas in which digits of one number stand apart."""
    return F.filter(F.regexp_extract_all(col(c), F.lit(r"\$([^$\n]+)\$"), 1), lambda m: m.rlike(r"\d\s+\d"))


def has_choices(c: Column | str) -> Column:
    """Whether all four options A to D stand in the text."""
    t = col(c)
    out = F.lit(True)
    for x, wide in zip("ABCD", "ＡＢＣＤ"):
        out = out & t.rlike(rf"(?:^|[\s　]){'[' + x + wide + ']'}[.．、]")
    return out


def has_blank(c: Column | str) -> Column:
    return col(c).rlike(r"_{2,}|（[\s　]*）|\([\s　]*\)")


def choice_letters(c: Column | str) -> Column:
    """The option letters that a solution concludes with; null if it names none."""
    found = F.lit(None).cast("string")
    for pattern in (r"(?:故选|应选|选)[:：]?\s*([A-D]+)", r"【答案】\s*([A-D]+)", r"(?i)answer(?:\s+is)?\s*[:：]?\s*([A-D]+)(?![A-Za-z])", r"^\s*([A-D]+)\s*[.。]?\s*$"):
        hit = F.regexp_extract(col(c), pattern, 1)
        found = F.coalesce(found, F.when(hit != "", hit))
    return found


def question_number(c: Column | str) -> Column:
    """The number of a question however it is written: the first digits, else the value of a Chinese numeral up to ninety-nine."""
    t = F.translate(F.regexp_replace(col(c), r"[\s　]", ""), "０１２３４５６７８９", "0123456789")
    digits = F.regexp_extract(t, r"(\d+)", 1)
    numeral = F.regexp_extract(t, r"([一二三四五六七八九十]+)", 1)
    ten, one = F.regexp_extract(numeral, r"^([一二三四五六七八九]?)十", 1), F.regexp_extract(numeral, r"([一二三四五六七八九])$", 1)
    return F.when(digits != "", F.substring(digits, 1, 9).try_cast("int")).when(numeral != "", _numeral(numeral, ten, one))


def _numeral(numeral: Column, ten: Column, one: Column) -> Column:
    unit = lambda x: F.coalesce(F.array_position(F.split(F.lit("一 二 三 四 五 六 七 八 九"), " "), x).cast("int"), F.lit(0))
    tens = F.when(numeral.contains("十"), F.when(ten == "", 1).otherwise(unit(ten))).otherwise(0)
    return (tens * 10 + unit(one)).cast("int")


def star_level(c: Column | str) -> Column:
    """Full stars count one, empty ones a half."""
    return F.regexp_count(col(c), F.lit("★")) + F.regexp_count(col(c), F.lit("☆")) * 0.5


def points(c: Column | str) -> Column:
    """The points in brackets at the beginning of a line, as text; null if there are none."""
    hit = F.regexp_extract(col(c), r"(?m)^\s*[（(](?:本题满分)?(\d+)\s*(?:分|marks)[)）]", 1)
    return F.when(hit != "", hit)


def strip_html(c: Column | str) -> Column:
    """Text without zero-width characters, tags and the common entities."""
    t = F.regexp_replace(col(c), r"[​-‏⁠﻿]", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)<br\s*/?>|</p>|</tr>", "\n"), r"<[^>]+>", "")
    for entity, to in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(to))
    return t
