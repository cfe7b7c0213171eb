"""Registered queries over articles in Markdown, and their SQL.

Articles are made of the documents in both engines alike: frontmatter, for every second one an infobox, later
lines as sections named by their first word, and for some tables, empty sections and closing sections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import markdown as M
from textloom.functions import text as T
from textloom.operators import package as P
from textloom.operators import questions as Q
from textloom.operators import search as S
from textloom.queries import _KEY, _STRIP, register
from textloom.session import table

_TABLE = "\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n\n| c |\n\nAfter it."
_CLOSING = "\n\n## See also\n\nOther things.\n\n### More\n\nAnd more.\n\n## Empty\n\n### Deep\n\n## Gallery\n## Last\n\nThe end."
_BODY = f"concat(regexp_replace(coalesce(text, ''), '\n([A-Za-z]+)', '\n\n## \\1\n\n\\1', 'g'), case when doc_id % 5 = 0 then '{_TABLE}' else '' end, case when doc_id % 3 = 0 then '{_CLOSING}' else '' end)"
_FRONT = "concat('---\ntitle: \"Doc ', doc_id, '\"\n', case when doc_id % 4 > 0 then concat('continuity: ', ['canon', 'legends', 'non-canon', 'real-world'][1 + doc_id % 4], '\n') else '' end, case when doc_id % 6 = 0 then 'url: https://example.org/own\n' else '' end, 'categories:\n  - \"', coalesce(lang, 'xx'), '\"\n  - ', source, '\n---\n\n')"
_BOX = "case when doc_id % 2 = 0 then concat('## Infobox\n- **Id:** ', doc_id, '\n- **Lang:**\n  - ', coalesce(lang, 'xx'), '\n') else '' end"
_ARTICLES = f"(select doc_id, source, lang, concat(source, '/', doc_id, '.md') as path, concat({_FRONT}, {_BOX}, '\n', {_BODY}, '\n') as text, {_BODY} as body from documents)"


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lang = F.col("doc_id"), F.coalesce("lang", F.lit("xx"))
    number = d.cast("string")
    body = F.concat(
        F.regexp_replace(F.coalesce("text", F.lit("")), "\n([A-Za-z]+)", "\n\n## $1\n\n$1"), F.when(d % 5 == 0, _TABLE).otherwise(""), F.when(d % 3 == 0, _CLOSING).otherwise("")
    )
    tag = F.get(F.array(*map(F.lit, ("canon", "legends", "non-canon", "real-world"))), (d % 4).cast("int"))
    front = F.concat(
        F.lit('---\ntitle: "Doc '), number, F.lit('"\n'), F.when(d % 4 > 0, F.concat(F.lit("continuity: "), tag, F.lit("\n"))).otherwise(""), F.when(d % 6 == 0, "url: https://example.org/own\n").otherwise(""),
        F.lit('categories:\n  - "'), lang, F.lit('"\n  - '), F.col("source"), F.lit("\n---\n\n"),
    )
    box = F.when(d % 2 == 0, F.concat(F.lit("## Infobox\n- **Id:** "), number, F.lit("\n- **Lang:**\n  - "), lang, F.lit("\n"))).otherwise("")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.concat_ws("/", "source", F.concat(number, F.lit(".md"))).alias("path"), front.alias("front"), box.alias("box"), body.alias("body"))
    return rows.withColumn("text", F.concat("front", "box", F.lit("\n"), "body", F.lit("\n")))


# Lines with their numbers, and the level of headings; a level ends where one as high begins.
_LINES = "(select doc_id, unnest(p) as line, generate_subscripts(p, 1) as i from (select doc_id, string_split({0}, '\n') as p from {1}))"


def _stripped(body: str, source: str) -> str:
    """CTEs up to ``bare`` (doc_id, body): without headings that have nothing under them."""
    return f"""l as (select *, case when regexp_matches(line, '^#{{2,6}} ') then length(regexp_extract(line, '^(#+)', 1)) else 0 end as level from {_LINES.format(body, source)}),
      h as (select a.doc_id, a.i, (select min(i) from l b where b.doc_id = a.doc_id and b.i > a.i and b.level between 1 and a.level) as stop from l a where a.level > 0),
      gone as (select doc_id, i from h where not exists (select 1 from l c where c.doc_id = h.doc_id and c.i > h.i and (h.stop is null or c.i < h.stop) and c.level = 0 and regexp_matches(c.line, '\\S'))),
      marked as (select l.*, g.i is not null as gone, max(case when regexp_matches(line, '\\S') then l.i end) over (partition by l.doc_id order by l.i) as solid from l left join gone g using (doc_id, i)),
      kept as (select m.* from marked m left join gone g on g.doc_id = m.doc_id and g.i = m.solid where g.i is null),
      bare as (select doc_id, {_STRIP.format("coalesce(string_agg(line, '\n' order by i), '')")} as body from (select distinct doc_id from l) left join kept using (doc_id) group by doc_id)"""


_FRONT_RE, _BOX_RE = "^(---\\n(?s:.*?)\\n---\\n)", "^(## Infobox\\n(?:-[^\\n]*\\n|[ \\t]+[^\\n]*\\n|[ \\t]*\\n)*)"
_SPLIT = f"(select *, regexp_extract(text, '{_FRONT_RE}', 1) as front, regexp_replace(regexp_replace(text, '{_FRONT_RE}', ''), '^\\n+', '') as rest from {_ARTICLES})"
_PARTS = f"(select *, regexp_extract(rest, '{_BOX_RE}', 1) as box, {_STRIP.format(f"regexp_replace(rest, '{_BOX_RE}', '')")} as inner_body from {_SPLIT})"
_SCALAR = "nullif(regexp_extract(front, '(?m)^{0}:[ \\t]*\"?(.*?)\"?[ \\t]*$', 1), '')"
_CATEGORIES = "regexp_extract_all(regexp_extract(front, '(?m)^categories:[ \\t]*\\n((?:[ \\t]+-[^\\n]*\\n)*)', 1), '(?m)^[ \\t]+-[ \\t]*\"?(.*?)\"?[ \\t]*$', 1)"
_BOXED = "case when box <> '' then concat(regexp_replace(box, '\\s+$', ''), '\n') else '' end"


@register(
    f"""with p as materialized {_PARTS}, {_stripped('inner_body', 'p')}
    select p.doc_id, {_SCALAR.format('title')} as title, {_SCALAR.format('continuity')} as continuity, array_to_string({_CATEGORIES}, '|') as categories, {_BOXED} as infobox, md5(b.body) as body, length(b.body)::int as chars
    from p join bare b using (doc_id)"""
)
def article_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frontmatter, infobox and body, the body without empty sections."""
    rows = _articles(spark, sf_dir).select("doc_id", M.frontmatter("text").alias("front"), M.infobox("text").alias("infobox"), M.body("text").alias("body"))
    return rows.select("doc_id", M.front_scalar("front", "title").alias("title"), M.front_scalar("front", "continuity").alias("continuity"), F.array_join(M.front_list("front", "categories"), "|").alias("categories"), "infobox", F.md5("body").alias("body"), F.char_length("body").alias("chars"))


@register(
    f"""with p as materialized {_PARTS}, {_stripped('inner_body', 'p')},
      r as (select p.*, b.body as kept, {_SCALAR.format('title')} as title, {_SCALAR.format('continuity')} as continuity, {_SCALAR.format('url')} as own, {_BOXED} as shown from p join bare b using (doc_id))
    select concat('origin/', path) as doc_id, title, continuity, 'origin' as source, coalesce(own, concat('https://example.org/', replace(title, ' ', '_'))) as url, array_to_string({_CATEGORIES}, '|') as categories, concat('base/', path) as derived_from, 'CC' as license,
      md5(concat('# ', title, '\n\n*origin', coalesce(' · ' || case continuity when 'canon' then 'Canon' when 'legends' then 'Legends' when 'non-canon' then 'Non-canon' when 'real-world' then 'Real-world' end, ''), '*\n',
        case when shown <> '' then concat('\n', regexp_replace(shown, '\\s+$', ''), '\n') else '' end, case when kept <> '' then concat('\n', kept, '\n') else '' end)) as text from r where shown <> '' or kept <> ''"""
)
def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.document_rows(_articles(spark, sf_dir).select("path", "text"), "origin", "CC", "https://example.org/", "base")
    return rows.select("doc_id", "title", "continuity", "source", "url", F.array_join("categories", "|").alias("categories"), "derived_from", "license", F.md5("text").alias("text"))


_SEGMENTS = f"""s as (select *, regexp_matches(line, '(?i)^[^\\S\\n]*(?:\\||</?(?:table|thead|tbody|tfoot|tr|th|td|caption)\\b)') as tabular from {_LINES.format('body', _ARTICLES)}),
      n as (select *, sum(change) over (partition by doc_id order by i) as run from (select *, case when tabular = lag(tabular) over (partition by doc_id order by i) then 0 else 1 end as change from s where regexp_matches(line, '\\S'))),
      r as (select doc_id, run, bool_and(tabular) as tabular, min(i) as a, max(i) as b from n group by doc_id, run),
      g as (select r.doc_id, r.run, r.tabular, string_agg(s.line, '\n' order by s.i) as part from r join s on s.doc_id = r.doc_id and s.i between r.a and r.b group by all)"""


@register(
    f"""with {_SEGMENTS} select d.doc_id, count(run)::int as segments, count(run) filter (tabular)::int as tables, coalesce(sum(length(part)) filter (not tabular), 0)::int as prose_chars, coalesce(sum(length(part)) filter (tabular), 0)::int as table_chars,
      md5(coalesce(string_agg({_STRIP.format('part')}, '\n\n' order by run) filter (not tabular), '')) as prose from documents d left join g using (doc_id) group by d.doc_id"""
)
def table_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.segments("body")
    return _articles(spark, sf_dir).select(
        "doc_id", F.size(found).alias("segments"), F.size(F.filter(found, M.is_table)).alias("tables"), M.prose_chars("body").alias("prose_chars"), M.table_chars("body").alias("table_chars"), F.md5(M.strip_tables("body")).alias("prose"),
    )


@register(
    f"""with recursive l as (select *, length(regexp_extract(line, '^(#+)\\s+(.+?)\\s*$', 1)) as level, lower({_STRIP.format("regexp_extract(line, '^(#+)\\s+(.+?)\\s*$', 2)")}) as name from {_LINES.format('body', _ARTICLES)}),
      r as (select doc_id, 0::bigint as i, null::bigint as skip from (select distinct doc_id from l) union all
        select l.doc_id, l.i, case when l.level > 0 and l.name in ({', '.join(f"'{n}'" for n in M.BOILERPLATE)}) then l.level when l.level > 0 and l.level <= r.skip then null else r.skip end from r join l on l.doc_id = r.doc_id and l.i = r.i + 1)
    select doc_id, md5(concat({_STRIP.format("regexp_replace(coalesce(string_agg(line, '\n' order by i), ''), '\\n{3,}', '\n\n', 'g')")}, '\n')) as kept from (select l.doc_id, l.i, case when r.skip is null then l.line end as line from l join r using (doc_id, i)) group by doc_id"""
)
def boilerplate_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir).select("doc_id", F.md5(M.strip_boilerplate("body")).alias("kept"))


@register(
    f"""with l as (select *, length(regexp_extract(line, '^(#{{2,}})\\s*(.+)$', 1)) as level, {_KEY.format("regexp_extract(line, '^(#{2,})\\s*(.+)$', 2)")} as key from {_LINES.format('body', _ARTICLES)}),
      f as (select doc_id, min(i) as a from l where level > 0 and key = 'see also' group by doc_id),
      e as (select f.doc_id, f.a, min(l.i) as b from f join l f0 on f0.doc_id = f.doc_id and f0.i = f.a left join l on l.doc_id = f.doc_id and l.i > f.a and l.level between 1 and f0.level group by all),
      s as (select e.doc_id, {_STRIP.format("string_agg(l.line, '\n' order by l.i)")} as section from e join l on l.doc_id = e.doc_id and l.i >= e.a and (e.b is null or l.i < e.b) group by e.doc_id),
      n as (select doc_id, count(*)::int as sections from l where regexp_matches(line, '^## .+$') group by doc_id)
    select d.doc_id, coalesce(n.sections, 0)::int as sections, s.section from documents d left join n using (doc_id) left join s using (doc_id)"""
)
def article_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir).select("doc_id", F.size(M.section_names("body")).alias("sections"), M.extract_section("body", "See_Also").alias("section"))


_NAMES = "coalesce(nullif(array_to_string(regexp_extract_all(body, '(?m)^## (.+)$', 1), ', '), ''), '(none)')"


@register(
    f"select doc_id, md5(case when length(body) <= 900 then body else concat(substr(body, 1, 900), '\n\n[truncated at 900 of ', length(body), ' characters. Sections you can recall: ', {_NAMES}, '. Call read_article again with `section` to read one of them in full.]') end) as shown from {_ARTICLES}"
)
def article_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir).select("doc_id", F.md5(M.truncate("body", 900)).alias("shown"))


@register(
    f"""with {_SEGMENTS}, p as (select doc_id, coalesce(sum(length(part)) filter (not tabular), 0) as prose from g group by doc_id),
      i as (select doc_id, count(*) filter (regexp_matches(line, '\\S')) as solid, count(*) filter (regexp_matches(line, '^\\s*- ')) as items from s group by doc_id)
    select reason, count(*)::bigint as n from (select case when length(a.body) < 300 then 'too short' when items >= 20 and items > 0.5 * solid then 'index list' when coalesce(prose, 0) < 300 then 'table only' else 'keep' end as reason
      from {_ARTICLES} a join i using (doc_id) left join p using (doc_id)) group by reason"""
)
def article_skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir).groupBy(F.coalesce(M.skip_reason("body", 300), F.lit("keep")).alias("reason")).agg(F.count("*").alias("n"))


def _cut(text: str, limit: str) -> str:
    head = f"substr({text}, 1, {limit})"
    last = lambda x: f"case when contains({head}, {x}) then length({head}) - instr(reverse({head}), reverse({x})) - length({x}) + 1 else -1 end"
    stop = f"greatest({last(repr('. '))}, {last("'.' || chr(10)")}, {last('chr(10) || chr(10)')})"
    return f"case when length({text}) <= {limit} then {text} when {limit} <= 0 then '' else regexp_replace(case when {stop} > {limit} * 0.5 then substr({head}, 1, {stop} + 1) else {head} end, '\\s+$', '') end"


@register(f"select doc_id, {_cut('text', '200')} as head, {_cut('text', '(50 + doc_id % 90)')} as start, lower({_STRIP.format("regexp_replace(substr(text, 1, 300), '\\s+', ' ', 'g')")}) as squashed from documents")
def text_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a limit keeps of each text, which is the feature here; and the function for comparing headings, on a title's length."""
    return table(spark, sf_dir, "documents").select("doc_id", T.cut("text", 200).alias("head"), T.cut("text", (50 + F.col("doc_id") % 90).cast("int")).alias("start"), T.squash_lower(F.substring("text", 1, 300)).alias("squashed"))


@register(
    f"""with s as (select doc_id, body, string_split_regex(body, '\\n## ') as raw from {_ARTICLES}),
      p as (select doc_id, body, list_transform(raw, lambda x, i: case when i > 1 then concat('## ', x) else x end) as parts from s),
      q as (select *, {_STRIP.format('parts[1]')} <> '' as led, {_cut(_STRIP.format('parts[1]'), '600')} as lead from p),
      r as (select doc_id, body, case when led then lead else '' end as lead, list_filter(list_transform(case when led then parts[2:] else parts end, lambda x: {_STRIP.format('x')}), lambda x: x <> '') as rest from q),
      t as (select *, (800 - length(lead)) // greatest(len(rest), 1) as share from r),
      o as (select doc_id, body, lead, share, unnest(rest) as sec, generate_subscripts(rest, 1) as i from t),
      u as (select doc_id, i, split_part(sec, '\n', 1) as head, {_STRIP.format("substr(sec, length(split_part(sec, '\n', 1)) + 2)")} as tail, share - length(split_part(sec, '\n', 1)) - 2 as lim from o),
      v as (select doc_id, i, head, {_cut('tail', 'lim')} as tail from u),
      w as (select doc_id, string_agg(case when tail <> '' then concat(head, '\n\n', tail) else head end, '\n\n' order by i) as openings from v group by doc_id),
      x as (select t.doc_id, t.body, array_to_string(list_filter([t.lead, coalesce(w.openings, '')], lambda y: y <> ''), '\n\n') as made from t left join w using (doc_id))
    select doc_id, case when length(body) <= 800 then body else {_cut('made', '800')} end as condensed from x"""
)
def article_condense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _articles(spark, sf_dir).select("doc_id", M.condense("body", 800).alias("condensed"))


@register(
    f"""with a as (select doc_id, concat(['', 'Here is the paraphrased text:', 'Sure, a reworded one', 'Certainly not so'][1 + doc_id % 4], '\n\n', body) as said from {_ARTICLES}),
      b as (select doc_id, {_STRIP.format("case when doc_id % 3 = 0 then concat('```markdown\n', said, '\n```') else said end")} as t from a),
      c as (select doc_id, case when regexp_matches(t, '(?s)^\\s*```(?:markdown|md)?\\s*\\n(.*)\\n```\\s*$') then {_STRIP.format("regexp_extract(t, '(?s)^\\s*```(?:markdown|md)?\\s*\\n(.*)\\n```\\s*$', 1)")} else t end as t from b)
    select doc_id, md5({_STRIP.format("regexp_replace(t, '(?i)^\\s*(?:here(?:''s| is)|sure[,!]?|certainly[,!]?)[^\\n]*(?:paraphras|rewrit|reword)[^\\n]*\\n+', '')")}) as cleaned from c"""
)
def response_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    said = F.concat(F.get(F.array(*map(F.lit, ("", "Here is the paraphrased text:", "Sure, a reworded one", "Certainly not so"))), (d % 4).cast("int")), F.lit("\n\n"), "body")
    fenced = F.when(d % 3 == 0, F.concat(F.lit("```markdown\n"), said, F.lit("\n```"))).otherwise(said)
    return _articles(spark, sf_dir).select("doc_id", F.md5(M.clean_response(fenced)).alias("cleaned"))


_WIKI = "concat('Start. [[Category:', source, ']] and [[category: Lang ', coalesce(lang, 'xx'), ' |sort', doc_id, ']]\n', case when doc_id % 2 = 0 then concat('[[Category:', source, '|again]]') else '' end, ' [[Link]] end')"


@register(f"select doc_id, array_to_string(list_filter(list_distinct_ordered, lambda x: x <> ''), '|') as names from (select doc_id, case when doc_id % 2 = 0 then [source, concat('Lang ', coalesce(lang, 'xx'))] else [source, concat('Lang ', coalesce(lang, 'xx'))] end as list_distinct_ordered from (select *, {_WIKI} as w from documents))")
def category_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lang = F.col("doc_id"), F.coalesce("lang", F.lit("xx"))
    w = F.concat(
        F.lit("Start. [[Category:"), "source", F.lit("]] and [[category: Lang "), lang, F.lit(" |sort"), d.cast("string"), F.lit("]]\n"), F.when(d % 2 == 0, F.concat(F.lit("[[Category:"), "source", F.lit("|again]]"))).otherwise(""), F.lit(" [[Link]] end")
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(M.categories(w), "|").alias("names"))


_TITLE = "concat(['Fo/o: ', '', '?x ', 'Äb '][1 + doc_id % 4], split_part(text, ' ', 1), ' ', doc_id)"


@register(
    f"""with t as (select doc_id, substr(replace(regexp_replace({_TITLE}, '[<>:"/\\\\|?*\\x00]', '_', 'g'), ' ', '_'), 1, 200) as safe from documents)
    select doc_id, concat(case when regexp_matches(safe, '^[\\p{{L}}\\p{{N}}]') then upper(substr(safe, 1, 1)) else '_' end, '/', safe, '.md') as file from t"""
)
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    title = F.concat(F.get(F.array(*map(F.lit, ("Fo/o: ", "", "?x ", "Äb "))), (d % 4).cast("int")), F.split_part("text", F.lit(" "), F.lit(1)), F.lit(" "), d.cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", P.file_name(title).alias("file"))


@register(
    f"""select doc_id, md5(concat('---\ntitle: "A \\"', doc_id, '\\" b"\ncontinuity: canon\nsource: ', source, '\n', case when doc_id % 3 > 0 then concat('categories:\n  - "', lang, '"\n  - "q\\"x"\n') else '' end, '---\n\n',
      case when doc_id % 2 = 0 then concat({_BOX}, '\n') else '' end, {_BODY}, '\n')) as article from documents"""
)
def article_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    cats = F.when(d % 3 > 0, F.array(F.coalesce("lang", F.lit("")), F.lit('q"x'))).otherwise(F.array().cast("array<string>"))
    made = P.article_document(F.concat(F.lit('A "'), d.cast("string"), F.lit('" b')), F.lit("canon"), F.col("source"), cats, F.col("box"), F.col("body"))
    return _articles(spark, sf_dir).select("doc_id", F.md5(made).alias("article"))


@register(
    f"""select doc_id, md5(concat(regexp_replace(regexp_replace({_FRONT}, '\\n$', ''), '---\\n$', ''), 'augmented_from: ', source, '\nview: quiz\n---\n\n', case when doc_id % 2 = 0 then concat({_BOX}, '\n') else '' end, {_BODY}, '\n')) as derived,
      md5(concat('---\ntitle: "Doc ', doc_id, ' (quiz)"\n', substr(regexp_replace(regexp_replace({_FRONT}, '\\n$', ''), '---\\n$', ''), length(concat('---\ntitle: "Doc ', doc_id, '"\n')) + 1), 'view: quiz\n---\n\n', {_BODY}, '\n')) as titled from documents"""
)
def derived_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    front = M.frontmatter("text")
    plain = P.derived_document(front, {"augmented_from": F.col("source"), "view": F.lit("quiz")}, F.col("box"), F.col("body"))
    titled = P.derived_document(front, {"view": F.lit("quiz")}, F.lit(""), F.col("body"), F.lit("(quiz)"))
    return _articles(spark, sf_dir).select("doc_id", F.md5(plain).alias("derived"), F.md5(titled).alias("titled"))


@register(
    f"""with s as (select length(regexp_replace(html, '<[^>]*>', '', 'g')) as n, regexp_replace(html, '<[^>]*>', '', 'g') as t, page_id from pages), r as (select page_id, case when page_id % 10 = 0 then 'TimeoutError: slow' when page_id % 10 = 1 then 'empty_after_clean' when length({_STRIP.format('t')}) < 200 then 'empty_after_clean' end as error from s)
    select coalesce(error, 'keep') as error, count(*)::bigint as n from r group by 1"""
)
def converted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    pages = table(spark, sf_dir, "pages").select(F.when(p % 10 > 1, F.regexp_replace("html", "<[^>]*>", "")).when(p % 10 == 1, "short").alias("body"), F.when(p % 10 == 0, "TimeoutError: slow").alias("error"))
    return Q.converted(pages, "body").groupBy(F.coalesce("error", F.lit("keep")).alias("error")).agg(F.count("*").alias("n"))


@register(
    """with k as (select c_custkey, c_name, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) as key from customer)
    select 'article' as kind, c_name as title, concat('Text of ', c_name) as text from k where key = 'customer 000000007'"""
)
def article_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.concat(F.lit("Text of "), "c_name").alias("text"))
    return S.read_article(people, "customer_000000007", "c_name", "text", "c_custkey")


@register(
    """with k as (select c_custkey, c_name, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) as key from customer)
    select 'near' as kind, c_name as title, null::varchar as text from k where contains(key, 'customer') and contains(key, '0000007') order by case when contains(key, 'customer 0000007') then 0 else 1 end, length(key), c_custkey limit 8"""
)
def article_lookup_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name that no article has: the eight nearest."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.concat(F.lit("Text of "), "c_name").alias("text"))
    return S.read_article(people, "Customer 0000007", "c_name", "text", "c_custkey")


@register(
    f"""with c as (select doc_id, unnest(p) as t, generate_subscripts(p, 1) as i from (select doc_id, string_split(body, '\n\n') as p from {_ARTICLES})),
      b as (select *, lag(t) over (partition by doc_id order by i) as before from c),
      q as (select *, {_STRIP.format(f"array_to_string(list_filter(string_split({_STRIP.format('before')}, '\n'), lambda x: not regexp_matches(x, '^\\s*#')), '\n')")} as prose from b),
      s as (select *, list_reverse(list_filter(string_split_regex(regexp_replace(prose, '([.!?])\\s+', '\\1\x01', 'g'), '\x01'), lambda x: x <> '')) as parts from q),
      u as (select *, list_transform(parts, lambda x, k: list_sum(list_transform(parts[1:k], lambda y: length(y) + 1))) as sizes from s),
      n as (select *, greatest(1, len(list_filter(sizes, lambda z: z <= 400))) as take from u)
    select doc_id, (i - 1)::int as chunk, case when before is null or regexp_matches(t, '^\\s*#') or regexp_matches(before, '(?i)^[^\\S\\n]*\\|') then '' else right(coalesce(array_to_string(list_reverse(parts[1:take]), ' '), ''), 400) end as context from n"""
)
def chunk_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of articles as chunks, each with the last sentences of the one before."""
    from pyspark.sql import Window

    rows = _articles(spark, sf_dir).select("doc_id", F.posexplode(F.split("body", "\n\n", -1)).alias("chunk", "t"))
    before = F.lag("t").over(Window.partitionBy("doc_id").orderBy("chunk"))
    return rows.withColumn("before", before).select("doc_id", "chunk", M.chunk_context(F.col("before"), F.col("t")).alias("context"))
