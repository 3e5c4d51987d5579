"""Queries on notes, names and records in running text, each over whole tables, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import graph, records, similarity
from ..sources.tables import table
from .catalog import SQL as CATALOG_SQL
from .catalog import link_answers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# ---- records ----------------------------------------------------------------

NUMBERED = r"^\s*(\d{1,3})\s*[.．、)）]"
HEADING = r"^(?:#{1,6}\s|第[一二三四五六七八九十百\d]+[章节]|[一二三四五六七八九十]+、)"
_LINES = "l as (select doc_id, unnest(string_split(text, chr(10))) as t, unnest(range(1, len(string_split(text, chr(10))) + 1)) as line from documents where text is not null)"


@query(rf"""
with {_LINES},
s as (select *, sum(case when regexp_matches(t, '^\s*\d{{1,3}}\s*[.．、)）]') then 1 else 0 end) over (partition by doc_id order by line) as record from l)
select doc_id, record::bigint as record, nullif(regexp_extract(arg_min(t, line), '^\s*(\d{{1,3}})\s*[.．、)）]', 1), '') as number, min(line)::bigint as first_line, max(line)::bigint as last_line, sha256(string_agg(t, chr(10) order by line)) as body_digest
from s where record > 0 group by doc_id, record""")
def numbered_records(spark, d):
    """Numbered items of every document, each from its number to the line before the next one."""
    lines = records.segment(T.lines(table(spark, d, "documents"), "doc_id", "text"), ["doc_id"], "line", F.col("text").rlike(NUMBERED)).filter("record > 0")
    out = records.bodies(lines, ["doc_id", "record"], "line", "text")
    number = F.regexp_extract("body", NUMBERED, 1)
    return out.select("doc_id", F.col("record").cast("long").alias("record"), F.when(number != "", number).alias("number"), F.col("first_line").cast("long").alias("first_line"), F.col("last_line").cast("long").alias("last_line"), F.sha2("body", 256).alias("body_digest"))


@query(rf"""
with {_LINES},
h as (select *, last_value(case when regexp_matches(t, '^(?:#{{1,6}}\s|第[一二三四五六七八九十百\d]+[章节]|[一二三四五六七八九十]+、)') then t end ignore nulls) over (partition by doc_id order by line) as heading from l)
select doc_id, coalesce(heading, '') as heading, count(*) as n_lines, count(*) filter (regexp_matches(t, '^\s*\d{{1,3}}\s*[.．、)）]')) as items, min(line)::bigint as first_line from h group by 1, 2""")
def section_items(spark, d):
    """The lines and numbered items below each heading of a document; those before the first heading have an empty one."""
    lines = T.lines(table(spark, d, "documents"), "doc_id", "text")
    under = records.inherit(lines, ["doc_id"], "line", F.when(F.col("text").rlike(HEADING), F.col("text")), "heading")
    return under.groupBy("doc_id", F.coalesce("heading", F.lit("")).alias("heading")).agg(F.count(F.lit(1)).alias("n_lines"), F.count(F.when(F.col("text").rlike(NUMBERED), 1)).alias("items"), F.min("line").cast("long").alias("first_line"))


@query(f"""
with m as ({CATALOG_SQL["link_answers"]}), c as (select status, count(*) as n from m group by 1)
select status, n, round(n / (select count(*) from m), 6) as share from c
union all select 'unmatched-answer', count(*), null from (select distinct question_id from questions where origin = 'manual' except select answer_id from m where answer_id is not null)""")
def link_rates(spark, d):
    """How many questions each status of the linkage has, and how many answers no question got."""
    m = link_answers(spark, d).select("status", "answer_id")
    rates = m.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    whole = m.agg(F.count(F.lit(1)).alias("all"))  # one row
    known = table(spark, d, "questions").filter("origin = 'manual'").select(F.col("question_id").alias("answer_id")).distinct()
    left = known.join(m.filter("answer_id is not null").select("answer_id"), "answer_id", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return rates.join(F.broadcast(whole)).select("status", "n", F.round(F.col("n") / F.col("all"), 6).alias("share")).union(left.select(F.lit("unmatched-answer"), "n", F.lit(None).cast("double")))


# ---- names ------------------------------------------------------------------


@query(r"select distinct key, substr(lower(regexp_replace(title, '[^\p{L}\p{N}]+', '', 'g')), 1, 240) as stem, case when n = '' then 'unnamed' else substr(n, 1, 36) end as safe_name from (select key, title, regexp_replace(regexp_replace(title, '[^\p{L}\p{N}]+', '_', 'g'), '^_+|_+$', '', 'g') as n from split_nodes)")
def title_names(spark, d):
    """Of each title the letters and digits that identify it, and a name for files."""
    return table(spark, d, "split_nodes").select("key", T.stem("title").alias("stem"), T.safe_name("title").alias("safe_name")).distinct()


@query(r"""
with t as (select distinct concept_key, trim(definition) as t from concepts where definition is not null), h as (select *, regexp_extract(t, '^(.{10,34}?)[，。；：,;:]', 1) as head from t)
select concept_key, case when length(t) <= 34 then t when head <> '' then head else substr(t, 1, 33) || '…' end as short from h""")
def short_definitions(spark, d):
    return table(spark, d, "concepts").filter("definition is not null").select("concept_key", T.compact_title("definition").alias("short")).distinct()


# ---- notes ------------------------------------------------------------------

_NOTE = r"""n as (select distinct key, '---' || chr(10) || 'key: ' || key || chr(10) || '---' || chr(10) || '# ' || title || chr(10) || 'See [' || title || '](' || filename || ') and ![x](img/' || key || '.png), [web](https://e.org/a) and [top](#top).' || chr(10) || '![[' || filename || '#part|shown]] ![[' || key || ']]' || chr(10) || '```' || chr(10) || '[code](not/a/link)' || chr(10) || '```' || chr(10) || 'End.  ' || chr(13) || chr(10) || chr(10) || chr(10) || chr(10) || chr(10) || 'Last' as note, filename from split_nodes where title is not null and filename is not null)"""


def _notes(spark: SparkSession, d: str) -> DataFrame:
    """(key, note): a Markdown note made of every section, with front matter, links, embeds and a block of code."""
    n = table(spark, d, "split_nodes").select("key", "title", "filename").filter("title is not null and filename is not null").distinct()
    parts = [F.lit("---\nkey: "), F.col("key"), F.lit("\n---\n# "), F.col("title"), F.lit("\nSee ["), F.col("title"), F.lit("]("), F.col("filename"), F.lit(") and ![x](img/"), F.col("key"), F.lit(".png), [web](https://e.org/a) and [top](#top).\n![["), F.col("filename"), F.lit("#part|shown]] ![["), F.col("key"), F.lit("]]\n```\n[code](not/a/link)\n```\nEnd.  \r\n\n\n\n\nLast")]
    return n.select("key", F.concat(*parts).alias("note"))


@query(f"""
with {_NOTE}, b as (select key, regexp_replace(note, '```[^`]*```\\n?', '', 'g') as t from n)
select key, array_to_string([x for x in regexp_extract_all(t, '!?\\[[^\\]]*\\]\\(([^)\\s]+)\\)', 1) if not regexp_matches(x, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:|#|//)')], ' ') as links,
  array_to_string([trim(regexp_extract(x, '^([^#|]*)', 1)) for x in regexp_extract_all(t, '!\\[\\[([^\\]]+)\\]\\]', 1)], '|') as embeds from b""")
def note_links(spark, d):
    """Local targets of links and embeds of every note, outside code."""
    return _notes(spark, d).select("key", F.array_join(T.link_targets("note"), " ").alias("links"), F.array_join(T.embed_targets("note"), "|").alias("embeds")).distinct()


@query(f"""
with {_NOTE}, s as (select key, filename, replace(note, chr(13) || chr(10), chr(10)) as unix from n)
select key, sha256(regexp_replace(regexp_replace(unix, '[ \\t]+\\n', chr(10), 'g'), '\\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')) as layout, substr(n.note, strpos(n.note, chr(10) || '---' || chr(10)) + 5) as body,
  length(regexp_replace(n.note, '!\\[[^\\]]*\\]\\([^)]*\\)|<[^>]+>|[\\s\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', '', 'g')) as visible from s join n using (key, filename)""")
def note_bodies(spark, d):
    """Notes without front matter, the digest of their standard layout, and their visible length."""
    return _notes(spark, d).select("key", F.sha2(T.standard_layout("note"), 256).alias("layout"), T.strip_frontmatter("note").alias("body"), T.visible_length("note").cast("long").alias("visible"))


@query(r"""
select question_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(solution_body, '\\[dt]frac', '\frac', 'g'), '\\(?:leqslant|leq|le)([^a-zA-Z]|$)', '\le \1', 'g'), '\\(?:geqslant|geq|ge)([^a-zA-Z]|$)', '\ge \1', 'g'), '\\left|\\right|\\displaystyle', '', 'g'), '[ \t\n\r\f\v]+', '', 'g') as latex
from (select distinct question_id, solution_body from questions)""".replace("'\\frac'", "'\\\\frac'").replace("'\\le \\1'", "'\\\\le \\1'").replace("'\\ge \\1'", "'\\\\ge \\1'"))
def latex_forms(spark, d):
    """Solutions with one spelling of fractions and relations."""
    return table(spark, d, "questions").select("question_id", "solution_body").distinct().select("question_id", T.unify_latex("solution_body").alias("latex"))


@query("""
with g as (select distinct question_id, list_distinct([substr(question_body, i::int, 8) for i in range(1, greatest(length(question_body) - 6, 2))]) as q, list_distinct([substr(solution_body, i::int, 8) for i in range(1, greatest(length(solution_body) - 6, 2))]) as s, question_body, solution_body from questions where question_body <> '' and solution_body <> ''),
c as (select question_id, question_body, solution_body, len(list_intersect(q, s)) / len(q) as a, len(list_intersect(q, s)) / len(s) as b from g)
select question_id, round(a, 6) as question_in_solution, round(b, 6) as solution_in_question, case when a >= 0.9 and b >= 0.9 then 'equivalent' when a >= 0.9 then 'contained' when b >= 0.9 then 'contains' when a >= 0.5 or b >= 0.5 then 'partial' else 'divergent' end as class from c""")
def shared_text(spark, d):
    """How much of a question stands in its solution and the other way round, in sequences of eight characters, and the class of the two."""
    q = table(spark, d, "questions").select("question_id", "question_body", "solution_body").filter("question_body != '' and solution_body != ''").distinct()
    q = q.select("question_id", T.ngrams("question_body", 8).alias("q"), T.ngrams("solution_body", 8).alias("s"))
    c = q.select("question_id", T.containment(F.col("q"), F.col("s")).alias("a"), T.containment(F.col("s"), F.col("q")).alias("b"))
    return c.select("question_id", F.round("a", 6).alias("question_in_solution"), F.round("b", 6).alias("solution_in_question"), similarity.containment_class(F.col("a"), F.col("b")).alias("class"))


@query("""
with recursive e as (select distinct 'book/' || book_key as a, 'type/' || node_type as b from split_nodes where book_key is not null and node_type is not null union select distinct 'type/' || node_type, 'category/' || category from split_nodes where node_type is not null and category is not null),
r as (select node, 0 as d from (select a as node from e union select b from e) union select e.b, r.d + 1 from r join e on e.a = r.node)
select node, max(d)::int as level from r group by node""")
def topological_levels(spark, d):
    """The level of books, node types and categories in the graph of what holds what."""
    n = table(spark, d, "split_nodes")
    edge = lambda x, a, y, b: n.select(F.concat(F.lit(x), F.col(a)).alias("src"), F.concat(F.lit(y), F.col(b)).alias("dst"))
    return graph.topological_levels(edge("book/", "book_key", "type/", "node_type").union(edge("type/", "node_type", "category/", "category")))
