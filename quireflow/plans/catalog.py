"""Queries for the operators of the inventory, each over whole tables, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import audits, geometry, graph, linkage, rules, sequences, similarity, state
from ..operators.skew import lookup_join
from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# ---- scans and profiles -----------------------------------------------------


@query("select doc_id, row_number() over (partition by doc_id order by i) as line, l as line_text from (select doc_id, unnest(string_split(text, chr(10))) as l, unnest(range(len(string_split(text, chr(10))))) as i from documents)")
def doc_lines(spark, d):
    """Numbered lines of every document."""
    return T.lines(table(spark, d, "documents"), "doc_id", "text").select("doc_id", F.col("line").cast("long").alias("line"), F.col("text").alias("line_text"))


@query("""
with l as (select doc_id, trim(unnest(string_split(text, chr(10)))) as label from documents),
c as (select doc_id, label, count(*) as n from l where label <> '' group by all having count(*) >= 2)
select doc_id, label, n, row_number() over (partition by doc_id order by n desc, label) as place from c""")
def repeated_lines(spark, d):
    """Labels that stand at least twice in a document, ranked."""
    lines = T.lines(table(spark, d, "documents"), "doc_id", "text").select("doc_id", F.trim("text").alias("label")).filter("label != ''")
    often = lines.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return sequences.occurrence(often, ["doc_id"], [F.desc("n"), F.col("label")], "place").withColumn("place", F.col("place").cast("long"))


@query("""
select doc_id, count(*) as n_lines, sum(case when trim(l) = '' then 1 else 0 end)::bigint as blank_lines, sum(case when regexp_matches(l, '^[0-9]+[.]') then 1 else 0 end)::bigint as numbered_lines,
 sum(case when contains(l, '$') then 1 else 0 end)::bigint as formula_lines, sum(length(l))::bigint as chars
from (select doc_id, unnest(string_split(text, chr(10))) as l from documents) group by doc_id""")
def line_profile(spark, d):
    lines = T.lines(table(spark, d, "documents"), "doc_id", "text")
    count = lambda c: F.count(F.when(c, 1))
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), count(F.trim("text") == "").alias("blank_lines"), count(F.col("text").rlike(r"^[0-9]+[.]")).alias("numbered_lines"), count(F.col("text").contains("$")).alias("formula_lines"), F.sum(F.length("text")).cast("long").alias("chars"))


_PROFILED = ["question_id", "section", "number", "answer", "lang", "solution_body"]


@query(" union all ".join(f"select '{c}' as \"column\", count(*) as \"rows\", count(*) - count({c}) as nulls, count(*) filter ({c} = '') as empties, count(distinct {c}) as distinct_values from questions" for c in _PROFILED))
def column_profile(spark, d):
    return audits.profile(table(spark, d, "questions"), _PROFILED)


@query("select coalesce(nullif(regexp_extract(filename, '[.]([^./]+)$', 1), ''), 'none') as extension, book_key, count(*) as files, sum(end_line - start_line + 1)::bigint as total_lines from (select distinct * from split_nodes) group by all")
def directory_inventory(spark, d):
    """Files by extension and folder."""
    ext = F.regexp_extract("filename", r"[.]([^./]+)$", 1)
    return table(spark, d, "split_nodes").distinct().groupBy(F.when(ext == "", "none").otherwise(ext).alias("extension"), "book_key").agg(F.count(F.lit(1)).alias("files"), F.sum(F.col("end_line") - F.col("start_line") + 1).cast("long").alias("total_lines"))


# ---- rules ------------------------------------------------------------------

_KINDS = [(r"^第.*章", "chapter"), (r"^(?:题型|专题)", "topic"), (r"^[0-9]+[.][0-9]+", "section"), (r"(?i)^(?:unit|chapter)", "unit"), (r"(?i)exercise|练习|习题", "exercise")]


@query("select key, case when regexp_matches(title, '^第.*章') then 'chapter' when regexp_matches(title, '^(?:题型|专题)') then 'topic' when regexp_matches(title, '^[0-9]+[.][0-9]+') then 'section' when regexp_matches(title, '(?i)^(?:unit|chapter)') then 'unit' when regexp_matches(title, '(?i)exercise|练习|习题') then 'exercise' else 'other' end as class from split_nodes")
def first_match_class(spark, d):
    return table(spark, d, "split_nodes").select("key", rules.first_match("title", _KINDS, "other").alias("class"))


_PREFIXES = [("bk-000000", 2, "early"), ("bk-0000000", 1, "main"), ("bk-00000", 3, "known"), ("pp-", 1, "paper")]


@query("""
with r(prefix, priority, class) as (values ('bk-000000', 2, 'early'), ('bk-0000000', 1, 'main'), ('bk-00000', 3, 'known'), ('pp-', 1, 'paper')),
q as (select distinct question_id, book_key from questions)
select question_id, (select class from r where starts_with(book_key, prefix) order by priority limit 1) as class from q""")
def rule_table_class(spark, d):
    """Class of the best rule of a rule table."""
    r = spark.createDataFrame(_PREFIXES, "prefix string, priority int, class string")
    return rules.rule_table_match(table(spark, d, "questions").select("question_id", "book_key").distinct(), "book_key", r, ["question_id"]).select("question_id", "class")


@query("select decision_id, case when confidence is null or confidence < 0.8 or action is null or left_ref is null or right_ref is null then 'needs_review' else 'auto_ready' end as route from merge_decisions")
def confidence_route(spark, d):
    m = table(spark, d, "merge_decisions")
    return m.select("decision_id", rules.route(F.col("confidence"), F.col("action").isNull(), F.col("left_ref").isNull(), F.col("right_ref").isNull()).alias("route"))


@query("select route, coalesce(nullif(lower(trim(action)), ''), 'none') as action, count(*) as n from (select *, case when confidence is null or confidence < 0.8 or action is null or left_ref is null or right_ref is null then 'needs_review' else 'auto_ready' end as route from merge_decisions) group by 1, 2")
def review_counts(spark, d):
    m = table(spark, d, "merge_decisions")
    at = rules.route(F.col("confidence"), F.col("action").isNull(), F.col("left_ref").isNull(), F.col("right_ref").isNull())
    act = F.lower(F.trim("action"))
    return m.groupBy(at.alias("route"), F.coalesce(F.when(act != "", act), F.lit("none")).alias("action")).agg(F.count(F.lit(1)).alias("n"))


@query(r"""
select question_id, regexp_matches(question_body, '(^|[\s　])[AＡ][.．、]') and regexp_matches(question_body, '(^|[\s　])[BＢ][.．、]') and regexp_matches(question_body, '(^|[\s　])[CＣ][.．、]') and regexp_matches(question_body, '(^|[\s　])[DＤ][.．、]') as choices,
  regexp_matches(question_body, '_{2,}|（[\s　]*）|\([\s　]*\)') as blank from (select distinct question_id, question_body from questions)""")
def question_shape(spark, d):
    """Whether a question has the options A to D, and a blank to fill in."""
    q = table(spark, d, "questions").select("question_id", "question_body").distinct()
    return q.select("question_id", T.has_choices("question_body").alias("choices"), T.has_blank("question_body").alias("blank"))


@query(r"""
select question_id, coalesce(nullif(regexp_extract(solution_body, '(?:故选|应选|选)[:：]?\s*([A-D]+)', 1), ''), nullif(regexp_extract(solution_body, '【答案】\s*([A-D]+)', 1), ''), nullif(regexp_extract(solution_body, '(?i)answer(?:\s+is)?\s*[:：]?\s*([A-D])(?:[^A-Za-z]|$)', 1), ''), nullif(regexp_extract(solution_body, '^\s*([A-D]+)\s*[.。]?\s*$', 1), '')) as letters
from (select distinct question_id, solution_body from questions)""")
def choice_answers(spark, d):
    q = table(spark, d, "questions").select("question_id", "solution_body").distinct()
    return q.select("question_id", T.choice_letters("solution_body").alias("letters"))


@query("select question_id, try_cast(nullif(regexp_extract(translate(number, '０１２３４５６７８９　 ', '0123456789'), '([0-9]+)', 1), '') as int) as n from (select distinct question_id, number from questions where number is null or not regexp_matches(number, '[一二三四五六七八九十]'))")
def question_numbers(spark, d):
    """Numbers of questions in digits or Chinese numerals; the SQL leaves out the numerals."""
    q = table(spark, d, "questions").select("question_id", "number").distinct()
    return q.select("question_id", T.question_number("number").alias("n"))


# ---- text functions ---------------------------------------------------------


@query("select key, lower(regexp_replace(title, '[ \\t\\n\\x{a0}\\x{3000}\\x{2000}-\\x{200a}\\x{202f}]+', '', 'g')) as plain, substr(sha256(title), 1, 12) as digest, length(title) as n from split_nodes")
def title_forms(spark, d):
    return table(spark, d, "split_nodes").select("key", T.compact("title").alias("plain"), F.substring(F.sha2("title", 256), 1, 12).alias("digest"), F.length("title").cast("long").alias("n"))


@query(r"select question_id, lower(regexp_replace(regexp_replace(solution_body, '\\(?:mathrm|mathbf|mathit|displaystyle)', '', 'g'), '[${}_ ]', '', 'g')) as plain, replace(solution_body, '\frac', '\dfrac') as long_fractions from questions")
def math_forms(spark, d):
    return table(spark, d, "questions").select("question_id", F.lower(F.regexp_replace(F.regexp_replace("solution_body", r"\\(?:mathrm|mathbf|mathit|displaystyle)", ""), r"[${}_ ]", "")).alias("plain"), T.lengthen_fractions("solution_body").alias("long_fractions"))


@query("select decision_id, 'pair-' || substr(sha256(coalesce(least(left_ref, right_ref), '') || chr(31) || coalesce(greatest(left_ref, right_ref), '')), 1, 16) as pair_id from merge_decisions")
def stable_keys(spark, d):
    return table(spark, d, "merge_decisions").select("decision_id", T.pair_key("pair-", "left_ref", "right_ref").alias("pair_id"))


@query(r"select key, case when t = '' then '_' else t end as file_name from (select key, regexp_replace(regexp_replace(title, '[<>:\x22/\\|?*\x00-\x1f]', '_', 'g'), '[. ]+$', '') as t from split_nodes)")
def safe_file_names(spark, d):
    return table(spark, d, "split_nodes").select("key", T.sanitize_file_name("title").alias("file_name"))


@query(r"select doc_id, (len(regexp_extract_all(text, '(?i)<td[\s>]')) - len(regexp_extract_all(text, '(?i)</td\s*>')))::bigint as open_cells, (len(regexp_extract_all(text, '(?i)<tr[\s>]')) - len(regexp_extract_all(text, '(?i)</tr\s*>')))::bigint as open_rows from documents")
def tag_balances(spark, d):
    return table(spark, d, "documents").select("doc_id", T.tag_balance("text", "td").cast("long").alias("open_cells"), T.tag_balance("text", "tr").cast("long").alias("open_rows"))


@query(r"select question_id, len(regexp_extract_all(question_body, '\$[^$\n]+\$'))::int as formulas, nullif(regexp_extract(question_body, '^\s*[（(](?:本题满分)?([0-9]+)\s*(?:分|marks)[)）]', 1), '') as points from questions")
def formula_counts(spark, d):
    return table(spark, d, "questions").select("question_id", F.regexp_count("question_body", F.lit(r"\$[^$\n]+\$")).alias("formulas"), T.points("question_body").alias("points"))


# ---- joins and linkage ------------------------------------------------------


@query("""
with q as (select distinct question_id, book_key, section, number from questions),
a as (select distinct question_id as answer_id, book_key, section, number from questions where origin = 'manual'),
s1 as (select book_key || '/' || section || '/' || number as v, count(*) n, min(answer_id) r from a where section is not null and number is not null group by 1),
s2 as (select book_key || '/' || number as v, count(*) n, min(answer_id) r from a where number is not null group by 1),
h as (select question_id, 0 as k, 'section-number' as name, n, r from q join s1 on v = book_key || '/' || section || '/' || number
      union all select question_id, 1, 'book-number', n, r from q join s2 on v = book_key || '/' || number),
p as (select question_id, count(distinct case when n = 1 then r end) as answers, bool_or(n > 1) as many, arg_min(name, k) filter (n = 1) as name, arg_min(r, k) filter (n = 1) as r from h group by 1),
x as (select q.question_id, answers, many, name, r, coalesce(answers = 1 and not many, false) as one from (select distinct question_id from q) q left join p using (question_id)),
y as (select *, row_number() over (partition by case when one then r end, one order by question_id) > 1 as claimed from x),
z as (select *, case when answers > 1 then 'conflicting-answer' when one and claimed then 'duplicate-answer' when one then 'matched' when many then 'duplicate-answer' else 'missing-answer' end as status from y)
select question_id, status, case when status = 'matched' then name end as strategy, case when status = 'matched' then r end as answer_id from z""")
def link_answers(spark, d):
    """Questions to answers by two strategies, with conflicts."""
    q = table(spark, d, "questions").select("question_id", "book_key", "section", "number", "origin").distinct()
    a = q.filter("origin = 'manual'").withColumnRenamed("question_id", "answer_id")
    both = lambda df: F.when(F.col("section").isNotNull() & F.col("number").isNotNull(), F.concat_ws("/", "book_key", "section", "number"))
    one = lambda df: F.when(F.col("number").isNotNull(), F.concat_ws("/", "book_key", "number"))
    return linkage.link(q, a, "question_id", "answer_id", [("section-number", both(q), both(a)), ("book-number", one(q), one(a))])


@query("select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def unmatched_orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey").join(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("""
with c as (select 'label' as channel, l, concept_key as r, 1.0 as score, true as hard from (select distinct concept_key, min(concept_key) over (partition by preferred_label, book_key) as l from concepts where preferred_label is not null and book_key is not null) where l < concept_key
 union all select 'decision', least(left_ref, right_ref), greatest(left_ref, right_ref), coalesce(confidence, 0), false from merge_decisions where left_ref <> right_ref)
select l as left_id, r as right_id, list_sort(list(distinct channel)) as channels, max(score)::double as score, bool_or(hard) as hard from c group by 1, 2""")
def candidate_pairs(spark, d):
    """Candidate pairs of two channels, merged. Concepts of one label in a book are paired with the least of them, which links all of them without all pairs."""
    c = table(spark, d, "concepts").select(F.col("concept_key").alias("r"), F.struct("preferred_label", "book_key").alias("at")).filter("at.preferred_label is not null and at.book_key is not null").distinct()
    least = c.groupBy("at").agg(F.min("r").alias("l"))
    same = lookup_join(c, least, "at", "r").filter("l < r").select("l", "r", F.lit("label").alias("channel"), F.lit(1.0).alias("score"), F.lit(True).alias("hard"))
    said = table(spark, d, "merge_decisions").select(F.col("left_ref").alias("l"), F.col("right_ref").alias("r"), F.lit("decision").alias("channel"), F.coalesce("confidence", F.lit(0.0)).alias("score"), F.lit(False).alias("hard"))
    return linkage.merge_candidates(same.union(said), "l", "r", "channel", "score", "hard")


@query("select target, count(distinct concept_key) as owners, min(concept_key) as first_owner from (select concept_key, unnest(aliases) as target from concepts) group by target")
def inverted_aliases(spark, d):
    return linkage.inverted_index(table(spark, d, "concepts"), "concept_key", "aliases")


@query("""
with b as (select distinct book_key, key, start_line, end_line from split_nodes where end_line - start_line between 0 and 400),
c as (select distinct concept_key, book_key, first_source_order as at from concepts)
select concept_key, count(key) as covering from c left join b on b.book_key = c.book_key and c.at between b.start_line and b.end_line group by concept_key""")
def range_cover(spark, d):
    """How many sections cover the place of each concept: an interval join through blocks of lines, so that no book is joined pair by pair. The SQL leaves out sections of more than 400 lines."""
    width = 400
    b = table(spark, d, "split_nodes").select("book_key", "key", "start_line", "end_line").distinct().filter("end_line >= start_line")
    b = b.withColumn("block", F.explode(F.sequence(F.floor(F.col("start_line") / width), F.floor(F.col("end_line") / width))))
    c = table(spark, d, "concepts").select("concept_key", "book_key", F.col("first_source_order").alias("at")).distinct().withColumn("block", F.floor(F.col("at") / width))
    hit = c.join(b, ["book_key", "block"], "left").withColumn("inside", F.col("at").between(F.col("start_line"), F.col("end_line")))
    return hit.groupBy("concept_key").agg(F.count(F.when(F.col("inside"), 1)).alias("covering"))


@query("""
with e as (select event_id, user_id, ts, event_type from events)
select event_id, max(case when event_type = 'view' then event_id end) over w as last_view from (select * from e) window w as (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding)""".replace("max(case when event_type = 'view' then event_id end) over w", "last_value(case when event_type = 'view' then event_id end ignore nulls) over w"))
def nearest_prior(spark, d):
    """The last view of the user before each event."""
    e = table(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    return sequences.last_before(e, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "view", F.col("event_id")), "last_view").select("event_id", "last_view")


# ---- sequences --------------------------------------------------------------


@query("""
with e as (select event_id, user_id, ts, case when ts - lag(ts) over w > interval 6 hours or lag(ts) over w is null then 1 else 0 end as new from events window w as (partition by user_id order by ts, event_id)),
i as (select *, sum(new) over (partition by user_id order by ts, event_id rows unbounded preceding) as island from e)
select user_id, island::bigint as island, count(*) as n, min(ts) as first_ts, max(ts) as last_ts from i group by all""")
def event_islands(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "ts")
    gap = F.col("ts") - F.col("_prev.ts") > F.expr("interval 6 hours")
    return sequences.islands(e, ["user_id"], ["ts", "event_id"], gap).groupBy("user_id", "island").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("select l_orderkey, min(n) as range_start, max(n) as range_end from (select *, n - row_number() over (partition by l_orderkey order by n) as g from (select distinct l_orderkey, l_linenumber as n from lineitem)) group by l_orderkey, g")
def owned_line_ranges(spark, d):
    return sequences.integer_ranges(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("select l_orderkey, unnest(range(n + 1, nx))::int as missing from (select l_orderkey, n, lead(n) over (partition by l_orderkey order by n) as nx from (select distinct l_orderkey, l_linenumber as n from lineitem)) where nx > n + 1")
def missing_numbers(spark, d):
    return sequences.missing_numbers(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("""
select l_orderkey, "at", expected, actual from (select l_orderkey, n as actual, row_number() over w as "at", lag(n) over w + 1 as expected from (select distinct l_orderkey, l_linenumber as n from lineitem) window w as (partition by l_orderkey order by n)) where expected <> actual""")
def ledger_gaps(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    return sequences.ledger_errors(lines, ["l_orderkey"], ["l_linenumber"], "l_linenumber").withColumn("at", F.col("at").cast("long"))


@query("""
with n as (select distinct book_key, key, start_line, end_line from split_nodes),
s as (select *, max(end_line) over (partition by book_key order by start_line, end_line rows between unbounded preceding and 1 preceding) as reach from n)
select book_key, kind, count(*) as n from (select book_key, case when end_line < start_line then 'reversed' when start_line > reach + 1 then 'gap' when start_line <= reach then 'overlap' end as kind from s) where kind is not null group by all""")
def tiling_errors(spark, d):
    n = table(spark, d, "split_nodes").select("book_key", "key", "start_line", "end_line").distinct()
    return sequences.tiling_errors(n, ["book_key"], "start_line", "end_line").groupBy("book_key", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
with n as (select distinct book_key, key, start_line, end_line from split_nodes where end_line >= start_line),
s as (select *, max(end_line) over (partition by book_key order by start_line, end_line rows between unbounded preceding and 1 preceding) as reach from n)
select book_key, reach + 1 as range_start, start_line - 1 as range_end from s where start_line > reach + 1""")
def uncovered_ranges(spark, d):
    n = table(spark, d, "split_nodes").select("book_key", "key", "start_line", "end_line").distinct()
    return sequences.uncovered_ranges(n, ["book_key"], "start_line", "end_line")


@query("""
with s as (select *, row_number() over (partition by book_key order by start_line, key) as pos, count(*) over (partition by book_key) as total, case organizer_type when 'chapter' then 1 when 'section' then 2 when 'topic' then 3 else 4 end as level from (select distinct key, book_key, start_line, organizer_type from split_nodes)),
w as (select *, min(case when level = 1 then pos end) over f as n1, min(case when level = 2 then pos end) over f as n2, min(case when level = 3 then pos end) over f as n3, min(case when level = 4 then pos end) over f as n4 from s window f as (partition by book_key order by pos rows between 1 following and unbounded following))
select key, pos, level, coalesce(least(n1, case when level >= 2 then n2 end, case when level >= 3 then n3 end, case when level >= 4 then n4 end) - 1, total) as range_end from w""")
def heading_ranges(spark, d):
    """Sections in reading order as headings: up to where does each reach?"""
    s = table(spark, d, "split_nodes").select("key", "book_key", "start_line", "organizer_type").distinct()
    level = F.when(F.col("organizer_type") == "chapter", 1).when(F.col("organizer_type") == "section", 2).when(F.col("organizer_type") == "topic", 3).otherwise(4)
    s = sequences.occurrence(s, ["book_key"], ["start_line", "key"], "pos").withColumn("pos", F.col("pos").cast("long")).withColumn("level", level).withColumn("total", F.count(F.lit(1)).over(Window.partitionBy("book_key")))
    return sequences.level_ranges(s, ["book_key"], "pos", "level", F.col("total"), range(1, 5)).select("key", "pos", "level", "range_end")


@query("select event_id, row_number() over (partition by user_id, event_type order by ts, event_id) as occurrence from events")
def occurrence_ids(spark, d):
    return sequences.occurrence(table(spark, d, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", F.col("occurrence").cast("long").alias("occurrence"))


@query()
def packed_lines(spark, d):
    """Orders' lines in packets of at most 100 units, greedily in order."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("l_quantity"))
    return sequences.pack(lines, ["l_orderkey"], "l_linenumber", "l_quantity", 100, "l_orderkey long, l_linenumber int, l_quantity double, packet int")


@query("""
with r as (select doc_id, row_number() over (order by length(text) desc, doc_id) - 1 as place from documents)
select doc_id, (case when (place // 16) % 2 = 0 then place % 16 else 15 - place % 16 end)::int as lane from r""")
def balanced_lanes(spark, d):
    """Documents dealt to sixteen lanes of nearly equal size."""
    return sequences.balance_lanes(table(spark, d, "documents").select("doc_id", F.length("text").alias("n")), "doc_id", "n", 16)


@query("select event_type, round(list_sort(list(value))[floor((count(value) - 1) * 0.9)::int + 1], 6) as p90, round(list_sort(list(value))[floor((count(value) - 1) * 0.5)::int + 1], 6) as p50 from events where value is not null group by event_type")
def value_percentiles(spark, d):
    """Percentiles as the value at the whole part of (n - 1) * p, from ranks instead of one long list."""
    e = table(spark, d, "events").select("event_type", "value").filter("value is not null")
    r = sequences.global_rank(e, [F.col("event_type"), F.col("value")], "r")
    sizes = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.sum("n").over(Window.orderBy("event_type")) - F.col("n"))
    at = lambda p: F.max(F.when(F.col("r") - F.col("start") == F.floor((F.col("n") - 1) * F.lit(p)) + 1, F.round("value", 6)))
    return r.join(F.broadcast(sizes), "event_type").groupBy("event_type").agg(at(0.9).alias("p90"), at(0.5).alias("p50"))


# ---- duplicates and similarity ----------------------------------------------


@query("with h as (select doc_id, text, min(doc_id) over (partition by text) as class_id, count(*) over (partition by text) as copies from documents) select doc_id, class_id, copies from h")
def exact_classes(spark, d):
    return similarity.exact_classes(table(spark, d, "documents"), "doc_id", F.col("text"))


@query("select substr(sha256(title), 1, 16) as digest, min(key) as key from split_nodes where title is not null group by sha256(title) having count(distinct key) = 1")
def unique_titles(spark, d):
    return similarity.unique_lookup(table(spark, d, "split_nodes"), "key", F.col("title")).select(F.substring("digest", 1, 16).alias("digest"), "key")


@query("""
with l as (select preferred_label as label, min(concept_key) as id, list_sort(list_distinct([substr(preferred_label, i::int, 2) for i in range(1, greatest(length(preferred_label), 2))])) as g from concepts where preferred_label is not null group by 1),
k as (select g, min(id) as id from l group by g),
e as (select id, unnest(g) as gram, len(g) as n from k),
p as (select a.id as left_id, b.id as right_id, count(*) as shared, a.n as n, b.n as m from e a join e b on a.gram = b.gram and a.id < b.id group by all)
select left_id, right_id, round(shared / (n + m - shared), 6) as similarity from p where shared / (n + m - shared) >= 0.8 - 1e-9""")
def label_jaccard(spark, d):
    """Labels whose sets of character pairs have a Jaccard similarity of 0.8 or more, each by its least concept; ``label_members`` has the concepts of each. Of labels with one set of pairs the SQL keeps one."""
    return _label_links(_labels(spark, d))


def _labels(spark: SparkSession, d: str) -> DataFrame:
    """(preferred_label, id, grams, class_id): every label with its least concept, and the least of all labels with its set of character pairs."""
    c = table(spark, d, "concepts").filter("preferred_label is not null").groupBy("preferred_label").agg(F.min("concept_key").alias("id")).withColumn("grams", F.array_sort(T.ngrams("preferred_label", 2)))
    return c.join(c.groupBy("grams").agg(F.min("id").alias("class_id")), "grams")


def _label_links(labels: DataFrame) -> DataFrame:
    """(left_id, right_id, similarity) of all pairs of different labels: the classes that are linked with all their labels, and the labels of one class."""
    classes = similarity.jaccard_join(labels, "id", "grams", 0.8).toDF("left_class", "right_class", "similarity")
    same = labels.groupBy("class_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("class_id").alias("left_class"), F.col("class_id").alias("right_class"), F.lit(1.0).alias("similarity"))
    a, b = labels.select(F.col("class_id").alias("left_class"), F.col("id").alias("a")), labels.select(F.col("class_id").alias("right_class"), F.col("id").alias("b"))
    pairs = classes.union(same).join(a, "left_class").join(b, "right_class").filter("left_class != right_class or a < b")
    return pairs.select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id"), F.round("similarity", 6).alias("similarity"))


@query("""
with c as (select distinct concept_key, preferred_label as label from concepts where preferred_label is not null),
l as (select label, min(concept_key) as label_id, list_sort(list_distinct([substr(label, i::int, 2) for i in range(1, greatest(length(label), 2))])) as g from c group by label),
k as (select label, label_id, min(label_id) over (partition by g) as class_id, g from l),
e as (select label_id as id, unnest(g) as gram, len(g) as n from k),
p as (select a.id, b.id as other, count(*) as shared, a.n as n, b.n as m from e a join e b on a.gram = b.gram and a.id <> b.id group by all),
t as (select id, count(*) as links from p where shared / (n + m - shared) >= 0.8 - 1e-9 group by id)
select concept_key, label_id, class_id, coalesce(links, 0) as links from c join k using (label) left join t on t.id = k.label_id""")
def label_members(spark, d):
    """Every concept with the id that stands for its label in ``label_jaccard``, the class of its set of character pairs, and the number of links of its label."""
    labels = _labels(spark, d)
    links = _label_links(labels)
    n = links.select(F.explode(F.array("left_id", "right_id")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("links"))
    of = labels.join(n, "id", "left").select("preferred_label", F.col("id").alias("label_id"), "class_id", F.coalesce("links", F.lit(0).cast("long")).alias("links"))
    c = table(spark, d, "concepts").select("concept_key", "preferred_label").filter("preferred_label is not null").distinct()
    # a label that very many concepts share is counted before the join
    return lookup_join(c, of, "preferred_label", "concept_key").select("concept_key", "label_id", "class_id", "links")


@query()
def item_containment(spark, d):
    """Evaluation items whose 12-character sequences stand for the half or more in one question."""
    items = table(spark, d, "eval_items").select("item_id", "item_text").distinct().select("item_id", T.ngrams("item_text", 12).alias("grams"))
    questions = table(spark, d, "questions").select("question_id", "question_body").distinct().select("question_id", T.ngrams("question_body", 12).alias("grams"))
    found = similarity.containment_join(items, questions, "item_id", "question_id", "grams", 0.5)
    return found.select("question_id", "item_id", "shared", F.round("containment", 6).alias("containment"))


@query("""
with q as (select vec_id as query_id, embedding::double[] as v from embeddings where vec_id % 100 = 0),
s as (select query_id, vec_id as neighbour_id, round(list_cosine_similarity(v, embedding::double[]), 6) as cosine, round(list_cosine_similarity(v, embedding::double[]), 9) as c from q, embeddings where vec_id <> query_id)
select query_id, neighbour_id, cosine, r::int as rank from (select *, row_number() over (partition by query_id order by c desc, neighbour_id) as r from s) where r <= 8""")
def cosine_topk(spark, d):
    """The eight nearest vectors of every query vector, against all rows."""
    e = table(spark, d, "embeddings")
    return similarity.vector_neighbours(e.filter("vec_id % 100 = 0"), e, "vec_id", "embedding", 8).select("query_id", "neighbour_id", F.round("cosine", 6).alias("cosine"), "rank")


# ---- graphs -----------------------------------------------------------------


@query("""
with recursive e as (select distinct left_ref a, right_ref b from merge_decisions where left_ref is not null and right_ref is not null and lower(trim(action)) = 'merge'),
s as (select a, b from e union select b, a from e), r as (select a as node, a as seen from s union select r.node, s.b from r join s on s.a = r.seen)
select node, min(seen) as component from r group by node""")
def components(spark, d):
    m = table(spark, d, "merge_decisions").filter(F.lower(F.trim("action")) == "merge")
    return graph.components(m, "left_ref", "right_ref")


@query("""
with recursive e as (select distinct key as a, parent_key as b from split_nodes where parent_key <> ''),
r as (select a, b from e union select r.a, e.b from r join e on e.a = r.b)
select distinct node from (select a as node from r where a in (select a from r where a = b) union select x.a from r x join (select distinct a from r where a = b) c on x.b = c.a)""")
def cycle_members(spark, d):
    """Sections on a circle of links, or with a path into one."""
    return graph.cycle_members(table(spark, d, "split_nodes").filter("parent_key != ''"), "key", "parent_key")


@query("""
with recursive e as (select distinct key as a, parent_key as b from split_nodes where parent_key <> ''),
r as (select a, b from e union select r.a, e.b from r join e on e.a = r.b)
select distinct a as node from r where a = b""")
def true_cycle_nodes(spark, d):
    return graph.true_cycle_nodes(table(spark, d, "split_nodes").filter("parent_key != ''"), "key", "parent_key")


@query("""
with e as (select distinct key as a, parent_key as b from split_nodes where parent_key <> '')
select distinct x.a as src, y.b as dst from e x join e y on y.a = x.b where x.a <> y.b""")
def two_hops(spark, d):
    return graph.two_hops(table(spark, d, "split_nodes").filter("parent_key != ''"), "key", "parent_key")


@query("""
with recursive e as (select distinct book_key as a, node_type as b from split_nodes where node_type is not null union select distinct node_type, category from split_nodes where node_type is not null and category is not null union select distinct book_key, category from split_nodes where category is not null),
p as (select e.a as src, x.b as dst from e join e x on x.a = e.b)
select distinct e.a as src, e.b as dst from e join p on p.src = e.a and p.dst = e.b""")
def redundant_edges(spark, d):
    """Edges from books to categories beside which a path over the node type leads to the same category."""
    n = table(spark, d, "split_nodes")
    e = n.select(F.col("book_key").alias("src"), F.col("node_type").alias("dst")).union(n.select("node_type", "category")).union(n.select("book_key", "category")).dropna().distinct()
    return graph.redundant_edges(e)


@query("""
select 'Book' as label, 'Book:' || book_key as key from (select distinct book_key from split_nodes) union all
select 'Organizer', 'Organizer:' || key from (select distinct key from split_nodes) union all
select 'Concept', 'Concept:' || concept_key from (select distinct concept_key from concepts)""")
def graph_nodes(spark, d):
    s, c = table(spark, d, "split_nodes"), table(spark, d, "concepts")
    return graph.export_bundle([("Book", s, "book_key"), ("Organizer", s, "key"), ("Concept", c, "concept_key")], [("HAS", s, "book_key", "key")])[0]


@query("select distinct 'HAS' as type, book_key as from_key, key as to_key from split_nodes union all select distinct 'DEFINES', book_key, concept_key from concepts")
def graph_edges(spark, d):
    s, c = table(spark, d, "split_nodes"), table(spark, d, "concepts")
    return graph.export_bundle([("Book", s, "book_key")], [("HAS", s, "book_key", "key"), ("DEFINES", c, "book_key", "concept_key")])[1]


@query()
def soft_pairs(spark, d):
    """Reviewed pairs by confidence, at most twelve for each concept, chosen greedily."""
    m = table(spark, d, "merge_decisions").filter("left_ref != right_ref and confidence is not null")
    p = m.groupBy(F.least("left_ref", "right_ref").alias("left_id"), F.greatest("left_ref", "right_ref").alias("right_id")).agg(F.max("confidence").alias("score")).withColumn("id", F.concat_ws("|", "left_id", "right_id"))
    return graph.greedy_degree_cap(p, 12)


# ---- audits -----------------------------------------------------------------


@query("""
select 'order-without-lines' as kind, o_orderkey::varchar as key, null::varchar as detail from orders where o_orderkey not in (select l_orderkey from lineitem)
union all select 'line-without-order', l_orderkey::varchar, null from (select distinct l_orderkey from lineitem) where l_orderkey not in (select o_orderkey from orders)
union all select 'unknown-left-ref', left_ref, null from (select distinct left_ref from merge_decisions where left_ref is not null) where left_ref not in (select concept_key from concepts)
union all select 'unknown-parent', parent_key, null from (select distinct parent_key from split_nodes where parent_key <> '') where parent_key not in (select key from split_nodes)""")
def reference_audit(spark, d):
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    nodes = table(spark, d, "split_nodes")
    return audits.report(
        audits.missing_references(orders, "o_orderkey", lines, "l_orderkey", "order-without-lines"),
        audits.missing_references(lines, "l_orderkey", orders, "o_orderkey", "line-without-order"),
        audits.missing_references(table(spark, d, "merge_decisions"), "left_ref", table(spark, d, "concepts"), "concept_key", "unknown-left-ref"),
        audits.missing_references(nodes.filter("parent_key != ''"), "parent_key", nodes, "key", "unknown-parent"),
    )


@query("select 'repeated-line' as kind, l_orderkey || '/' || l_linenumber as key, count(*)::varchar as detail from lineitem group by l_orderkey, l_linenumber having count(*) > 1")
def repeated_line_keys(spark, d):
    return audits.repeated_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "repeated-line")


@query("""
with e as (select l_orderkey, max(l_linenumber) as n from lineitem group by 1), a as (select l_orderkey, count(*) as n from lineitem group by 1)
select 'line-count' as kind, l_orderkey::varchar as key, e.n || ' != ' || a.n as detail from e join a using (l_orderkey) where e.n <> a.n""")
def count_expectations(spark, d):
    lines = table(spark, d, "lineitem")
    e = lines.groupBy("l_orderkey").agg(F.max("l_linenumber").cast("long").alias("n"))
    return audits.count_differences(e, lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")), ["l_orderkey"], "n", "line-count")


@query("select 'books-without-concepts' as kind, book_key as key, null::varchar as detail from (select book_key from split_nodes where book_key is not null except select book_key from concepts) union all select 'concepts-without-sections', book_key, null from (select book_key from concepts where book_key is not null except select book_key from split_nodes)")
def set_differences(spark, d):
    return audits.set_differences(table(spark, d, "split_nodes"), table(spark, d, "concepts"), "book_key", ("books-without-concepts", "concepts-without-sections"))


@query("select coalesce(a.book_key, b.book_key) as book_key, coalesce(a.n, 0) as left_count, coalesce(b.n, 0) as right_count from (select book_key, count(*) n from questions group by 1) a full join (select book_key, count(*) n from source_assets group by 1) b on a.book_key = b.book_key where coalesce(a.n, 0) <> coalesce(b.n, 0)")
def multiset_differences(spark, d):
    return audits.multiset_differences(table(spark, d, "questions"), table(spark, d, "source_assets"), "book_key")


@query("select 'confidence' as kind, decision_id::varchar as key, confidence::varchar as detail from merge_decisions where confidence is null or confidence < 0.25 or confidence > 1")
def confidence_audit(spark, d):
    return audits.out_of_range(table(spark, d, "merge_decisions"), "decision_id", "confidence", 0.25, 1.0, "confidence")


@query("select coalesce(lang, 'none') as lang, coalesce(kind, 'all') as kind, count(*) as n, count(distinct question_id) as ids from questions group by grouping sets ((lang, kind), (lang)) having lang is not null and (kind is not null or grouping(kind) = 1)")
def quality_rollup(spark, d):
    q = table(spark, d, "questions").filter("lang is not null and kind is not null")
    fine = q.groupBy("lang", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("question_id").alias("ids"))
    return fine.union(q.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("question_id").alias("ids")).select("lang", F.lit("all"), "n", "ids"))


# ---- state ------------------------------------------------------------------


@query("""
with o as (select doc_id, sha256(text) as h from documents where source = 'textbook'), n as (select doc_id, sha256(case when doc_id % 7 = 0 then text || 'x' else text end) as h from documents where doc_id % 5 <> 0)
select doc_id, case when o.h is null then 'added' when n.h is null then 'removed' else 'changed' end as change from o full join n using (doc_id) where o.h is null or n.h is null or o.h <> n.h""")
def delta_audit(spark, d):
    """What differs between two versions of the documents."""
    docs = table(spark, d, "documents")
    old = docs.filter("source = 'textbook'").select("doc_id", F.sha2("text", 256).alias("h"))
    new = docs.filter("doc_id % 5 != 0").select("doc_id", F.sha2(F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), 256).alias("h"))
    return state.changes(old, new, "doc_id", "h")


@query("""
with b as (select doc_id, sha256(text) as h from documents where doc_id % 3 <> 0), s as (select doc_id, sha256(case when doc_id % 4 = 0 then text || 'y' else text end) as h from documents), n as (select doc_id, sha256(case when doc_id % 7 = 0 then text || 'x' else text end) as h from documents where doc_id % 5 <> 0)
select doc_id, case when n.h is null then 'missing' when b.h is null then 'unknown' when n.h <> b.h then 'manually_modified' when s.h is null or s.h = b.h then 'unchanged' else 'updated' end as state from b full join s using (doc_id) full join n using (doc_id)""")
def three_way_state(spark, d):
    docs = table(spark, d, "documents")
    version = lambda c, k: F.sha2(F.when(F.col("doc_id") % c == 0, F.concat("text", F.lit(k))).otherwise(F.col("text")), 256).alias("h")
    return state.three_way_state(docs.filter("doc_id % 3 != 0").select("doc_id", F.sha2("text", 256).alias("h")), docs.select("doc_id", version(4, "y")), docs.filter("doc_id % 5 != 0").select("doc_id", version(7, "x")), "doc_id", "h")


@query("""
with known as (select distinct preferred_label as label from concepts where kind = 'method' and preferred_label is not null), k as (select label, row_number() over (order by label) as n from known),
f as (select label, (select max(n) from k) + row_number() over (order by label) as n from (select distinct preferred_label as label from concepts where preferred_label is not null except select label from known))
select label, n, false as fresh from k union all select label, n, true from f""")
def allocated_ids(spark, d):
    """Numbers of labels: known ones keep theirs, new ones get the next."""
    labels = table(spark, d, "concepts").select(F.col("preferred_label").alias("label"), "kind").filter("label is not null")
    known = sequences.global_rank(labels.filter("kind = 'method'").select("label").distinct(), [F.col("label")], "n")
    return state.allocate_ids(known, labels, "label", "n")


@query("""
select distinct on (left_ref, right_ref) left_ref, right_ref, decision_id, action from (select distinct * from merge_decisions) where left_ref is not null and right_ref is not null order by left_ref, right_ref, decided_at desc, decision_id desc""")
def latest_decisions(spark, d):
    """The latest decision of each ordered pair."""
    m = table(spark, d, "merge_decisions").filter("left_ref is not null and right_ref is not null")
    last = m.groupBy("left_ref", "right_ref").agg(F.max_by(F.struct("decision_id", "action"), F.struct("decided_at", "decision_id")).alias("r"))
    return last.select("left_ref", "right_ref", "r.decision_id", "r.action")


@query("select source, count(*) as rows from documents group by source")
def source_fingerprints(spark, d):
    """Rows of each source of ``source_digests``, without the digests."""
    return source_digests(spark, d).select("source", "rows")


@query("""
with h as (select source, sha256(concat_ws(chr(31), coalesce('=' || doc_id, '~'), coalesce('=' || text, '~'))) as h from documents),
s as (select source, count(*) as rows, """ + ", ".join(f"sum(('0x' || substr(h, {1 + 15 * k}, 15))::bigint::hugeint) % 1152921504606846976 as s{k}" for k in range(4)) + """ from h group by source)
select source, rows, sha256(concat_ws('/', s0, s1, s2, s3)) as digest from s""")
def source_digests(spark, d):
    """Digest of all documents of each source, whatever their order."""
    docs = table(spark, d, "documents").select("source", state.row_digest("doc_id", "text").alias("h"))
    return state.table_digest(docs, ["source"], "h")


# ---- geometry ---------------------------------------------------------------


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_size")
    return p.select(F.col("p_partkey").alias("id"), ((F.col("p_partkey") * 37) % 4001).cast("double").alias("x"), ((F.col("p_partkey") * 91) % 3989).cast("double").alias("y"), F.col("p_size").cast("double").alias("w"), ((F.col("p_size") * 7) % 40 + 1).cast("double").alias("h"))


_BOXES = "with b as (select p_partkey as id, ((p_partkey * 37) % 4001)::double as x, ((p_partkey * 91) % 3989)::double as y, p_size::double as w, ((p_size * 7) % 40 + 1)::double as h from part) "


@query(_BOXES + "select a.id as left_id, b.id as right_id from b a join b on a.id < b.id and a.x < b.x + b.w and b.x < a.x + a.w and a.y < b.y + b.h and b.y < a.y + a.h where a.w > 0 and b.w > 0")
def overlapping_boxes(spark, d):
    return geometry.overlapping_boxes(_boxes(spark, d), "id", 64.0)


@query(_BOXES + "select a.id as outer_id, b.id as inner_id from b a join b on a.id <> b.id and a.x <= b.x and a.y <= b.y and b.x + b.w <= a.x + a.w and b.y + b.h <= a.y + a.h")
def contained_boxes(spark, d):
    return geometry.contained_boxes(_boxes(spark, d), "id", 64.0)


@query(_BOXES + "select min(x) as \"left\", min(y) as top, max(x + w) - min(x) as width, max(y + h) - min(y) as height, count(*) as boxes, round(stddev_pop(w) / avg(w), 6) as width_spread from b")
def box_bounds(spark, d):
    return geometry.bounds(_boxes(spark, d), []).withColumn("width_spread", F.round("width_spread", 6))


# ---- names and layouts ------------------------------------------------------


@query("""
with n as (select distinct book_key, key, title from split_nodes where title is not null and book_key is not null), c as (select book_key, title, count(*) as n from n group by all)
select key, case when c.n = 1 then title else title || ' ' || key end as short_name from n join c using (book_key, title)""")
def unique_short_names(spark, d):
    """The title where it is unique in its book, else with the key; a title that very many sections share is counted before the join."""
    n = table(spark, d, "split_nodes").select("book_key", "key", "title").filter("title is not null and book_key is not null").distinct().withColumn("at", F.struct("book_key", "title"))
    c = n.groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    return lookup_join(n, c, "at", "key").select("key", F.when(F.col("n") == 1, F.col("title")).otherwise(F.concat_ws(" ", "title", "key")).alias("short_name"))


@query("select book_key, lower(title) as folded, count(distinct title) as spellings, count(distinct key) as sections from split_nodes where title is not null and book_key is not null group by 1, 2 having count(distinct title) > 1")
def name_collisions(spark, d):
    """Titles of a book that differ in letter case alone."""
    n = table(spark, d, "split_nodes").filter("title is not null and book_key is not null")
    return n.groupBy("book_key", F.lower("title").alias("folded")).agg(F.count_distinct("title").alias("spellings"), F.count_distinct("key").alias("sections")).filter("spellings > 1")


@query("select concept_key, concat_ws(chr(10), preferred_label, case when len(aliases) > 0 then array_to_string(list_sort(aliases), '; ') end, definition) as retrieval_text from (select distinct * from concepts)")
def concept_texts(spark, d):
    """Label, aliases and definition as one text for retrieval."""
    c = table(spark, d, "concepts").distinct()
    return c.select("concept_key", F.concat_ws("\n", "preferred_label", F.when(F.size("aliases") > 0, F.array_join(F.sort_array("aliases"), "; ")), "definition").alias("retrieval_text"))


@query(
    _BOXES
    + """, s as (select w, x, id, case when lag(x) over v is null or x - lag(x) over v >= 60 then 1 else 0 end as new from b window v as (partition by w order by x, id))
select w, sum(new)::bigint as bands, count(*) as boxes from s group by w"""
)
def column_bands(spark, d):
    """Bands of left edges of the boxes of each width, apart by 60 or more."""
    b = _boxes(spark, d).select("w", "x", "id")
    bands = sequences.islands(b, ["w"], ["x", "id"], F.col("x") - F.col("_prev.x") >= 60)
    return bands.groupBy("w").agg(F.max("island").alias("bands"), F.count(F.lit(1)).alias("boxes"))
