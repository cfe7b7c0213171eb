"""Registered queries of the engine's operators, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import markdown as M
from textloom.functions import text as T
from textloom.operators import gates as G
from textloom.operators import search as S
from textloom.operators import shards as H
from textloom.operators import tables as B
from textloom.session import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# SQL that several queries share: DuckDB has RE2 patterns and its own lambda syntax.
_LOW = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_KEY = "trim(regexp_replace(lower(replace({0}, '_', ' ')), '[^a-z0-9]+', ' ', 'g'))"
_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_WORDS = "list_transform(regexp_extract_all({0}, '[A-Za-z0-9'']+'), lambda w: lower(w))"
_STOP = "[" + ", ".join(f"'{w}'" for w in T.STOPWORDS) + "]"
_SET = f"list_filter(list_distinct({_WORDS}), lambda w: not list_contains({_STOP}, w))"


def _pages_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown from pages: headings, paragraphs and items by pattern, other tags dropped."""
    md = F.col("html")
    for pattern, to in _PAGE_RULES:
        md = F.regexp_replace(md, pattern, to)
    return table(spark, sf_dir, "pages").select("page_id", "url", M.strip(md).alias("md"))


# Pattern and replacement, in order; both engines read them alike.
_PAGE_RULES = (
    ("(?s)<script[^>]*>.*?</script>", ""), ("(?s)<style[^>]*>.*?</style>", ""), ("(?s)<!--.*?-->", ""), ("(?s)<head>.*?</head>", ""),
    ("<h1[^>]*>", "\n\n## "), ("<li[^>]*>", "\n- "), ("<p[^>]*>", "\n\n"), ("<footer[^>]*>", "\n\n## Sources\n\n"), ("<nav[^>]*>", "\n\n## Gallery\n"), ("<article[^>]*>", "\n\n"), ("<[^>]*>", ""),
)


def _pages_sql() -> str:
    out = "html"
    for pattern, to in _PAGE_RULES:
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return f"(select page_id, url, {_STRIP.format(out)} as md from pages)"


# Search -----------------------------------------------------------------------------------------


@register(
    f"""with c as (select doc_id, {_KEY.format("concat(source, ' ', lang)")} as key, text,
      (length({_LOW.format('text')}) - length(replace({_LOW.format('text')}, 'the an', ''))) // length('the an') as hits from documents)
    select doc_id, key, cast(hits as bigint) as hits, cast(hits + 30 * (contains(key, 'the')::int + contains(key, 'an')::int) as bigint) as score,
      case when length(l) > 400 then concat(substr(l, 1, 400), '...') else l end as snippet
    from (select *, {_STRIP.format("list_filter(string_split(text, chr(10)), lambda x: contains(lower(x), 'the an'))[1]")} as l from c where hits > 0)
    order by score desc, length(key), key, doc_id limit 20"""
)
def search_text_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.search_text(table(spark, sf_dir, "documents"), "the an", F.concat_ws(" ", "source", "lang"), "doc_id", limit=20)


@register("select doc_id, cast(len(regexp_extract_all(text, '(?i)tion[a-z]* (?:of|the)')) as bigint) as hits from documents where regexp_matches(text, '(?i)tion[a-z]* (?:of|the)')")
def search_regex_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.count_matches(table(spark, sf_dir, "documents"), "tion[a-z]* (?:of|the)", regex=True).select("doc_id", "hits")


@register(f"select sum((length({_LOW.format('text')}) - length(replace({_LOW.format('text')}, 'ing', ''))) // 3)::bigint as hits, count_if(contains({_LOW.format('text')}, 'ing'))::bigint as documents from documents")
def search_match_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.count_matches(table(spark, sf_dir, "documents"), "ing").agg(F.sum("hits").alias("hits"), F.count("*").alias("documents"))


@register(
    f"""with k as (select p_partkey, p_name, {_KEY.format("concat(p_name, case when p_partkey % 3 = 0 then ' No_' || p_partkey % 7 else '' end)")} as key from part)
    select p_partkey, p_name, key, case when key = 'small ring' then 100 when starts_with(key, 'small ring ') then 80 when contains(key, 'small ring') then 60 else 40 end::int as score
    from k where contains(key, 'small') and contains(key, 'ring') order by score desc, length(key), p_partkey limit 40"""
)
def search_titles_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" No_"), (F.col("p_partkey") % 7).cast("string"))).otherwise("")).alias("title"))
    found = S.search_titles(parts, "Small_Ring", "title", "p_partkey", 40)
    return found.join(parts.select("p_partkey", "p_name"), "p_partkey").select("p_partkey", "p_name", "key", "score")


@register(
    f"""with c as (select c_custkey, {_KEY.format("regexp_replace(c_name, '[0-9]$', '')")} as key from customer), f as (select key, min(c_custkey) as first_key from c group by key)
    select c.c_custkey, c.key, f.first_key from c join f using (key)"""
)
def title_resolve_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "customer").select("c_custkey", F.regexp_replace("c_name", "[0-9]$", "").alias("name"))
    first = names.select(F.col("c_custkey").alias("first_key"), F.col("name").alias("article"))
    return S.resolve_titles(names, first, "name", "article", ["first_key"]).select("c_custkey", "key", "first_key")


# Keys, sets, splits -----------------------------------------------------------------------------


@register(
    """select doc_id, concat('0x', substr(sha1(concat(source, '/', doc_id)), 1, 8))::bigint / 4294967296.0 as share,
      case when concat('0x', substr(sha1(concat(source, '/', doc_id)), 1, 8))::bigint / 4294967296.0 < 0.02 then 'eval' else 'train' end as split from documents"""
)
def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.concat_ws("/", "source", F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", T.hash_share(path).alias("share"), T.assign_split(path).alias("split"))


_EVAL = "concat('0x', substr(sha1(concat(source, '/', doc_id % 400)), 1, 8))::bigint / 4294967296.0 < 0.1"


@register(
    f"""select source, count(*) filter ({_EVAL})::bigint as eval, count(*) filter (not {_EVAL})::bigint as train,
      count(distinct doc_id % 400) filter ({_EVAL})::bigint + count(distinct doc_id % 400) filter (not {_EVAL})::bigint - count(distinct doc_id % 400)::bigint as shared from documents group by source"""
)
def split_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of several articles (many rows have one path): sizes of both splits, and paths that are in both."""
    path = F.concat_ws("/", "source", (F.col("doc_id") % 400).cast("string"))
    docs = table(spark, sf_dir, "documents").select("source", path.alias("path"), T.assign_split(path, 0.1).alias("split"))
    both = docs.groupBy("source", "path").agg(F.count_if(F.col("split") == "eval").alias("e"), F.count_if(F.col("split") == "train").alias("t"))
    return both.groupBy("source").agg(F.sum("e").alias("eval"), F.sum("t").alias("train"), F.count_if((F.col("e") > 0) & (F.col("t") > 0)).alias("shared"))


@register(f"select min(doc_id) as doc_id, array_to_string({_WORDS.format('any_value(text)')}, ' ') as key, count(*)::bigint as copies from documents group by array_to_string({_WORDS.format('text')}, ' ')")
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "documents").select("doc_id", T.dedup_key("text").alias("key"))
    return keyed.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@register(f"select conv_id, turn from (select conv_id, turn, row_number() over (partition by array_to_string({_WORDS.format('text')}, ' ') order by conv_id, turn) as n from conversations) where n = 1")
def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.first_wins(table(spark, sf_dir, "conversations"), T.dedup_key("text"), ["conv_id", "turn"]).select("conv_id", "turn")


@register(
    f"""with recursive t as (select conv_id, turn, row_number() over (partition by conv_id order by turn) as i, {_SET.format('text')} as s from conversations),
    r as (select conv_id, turn, i, [s] as kept, true as keep from t where i = 1
      union all
      select t.conv_id, t.turn, t.i, case when d then r.kept else list_append(r.kept, t.s) end, not d from r join t on t.conv_id = r.conv_id and t.i = r.i + 1,
      lateral (select coalesce(list_bool_or(list_transform(r.kept, lambda k: len(list_distinct(list_concat(k, t.s))) > 0 and len(list_intersect(k, t.s)) >= 0.2 * len(list_distinct(list_concat(k, t.s))))), false) as d))
    select conv_id, turn, keep from r"""
)
def near_dup_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At a threshold that these short turns reach."""
    return B.near_duplicates(table(spark, sf_dir, "conversations"), "conv_id", "turn", T.token_set("text"), 0.2)


@register(
    f"""with t as (select conv_id, turn, {_SET.format('text')} as s from conversations)
    select a.conv_id, a.turn as a, b.turn as b, round(case when len(list_distinct(list_concat(a.s, b.s))) > 0 then len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s))) else 0 end, 6) as likeness
    from t a join t b on a.conv_id = b.conv_id and a.turn < b.turn"""
)
def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of turns of one conversation, which is short by nature."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", T.token_set("text").alias("s"))
    a, b = t.select("conv_id", F.col("turn").alias("a"), F.col("s").alias("x")), t.select("conv_id", F.col("turn").alias("b"), F.col("s").alias("y"))
    return a.join(b, "conv_id").where("a < b").select("conv_id", "a", "b", F.round(T.jaccard(F.col("x"), F.col("y")), 6).alias("likeness"))


_WHOLE_MATCH = _STRIP.format("regexp_replace(lower(replace(replace(text, '*', ''), '_', ' ')), '\\s+', ' ', 'g')")


@register(f"select doc_id, md5({_KEY.format('text')}) as title_key, md5({_WHOLE_MATCH}) as match_key from documents")
def normalizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts; as digests, since the keys are as long as the texts."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.normalize_title("text")).alias("title_key"), F.md5(T.normalize_match("text")).alias("match_key"))


@register("select doc_id, greatest(2, least(12, n_chars // 700))::int as questions from documents")
def question_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.question_count("n_chars").alias("questions"))


@register(
    r"""with d as (select event_id, concat('In ', event_id % 97, ',', 100 + event_id % 800, ' BBY and ', event_id % 40, 'ABY ', event_type) as t from events)
    select event_id, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(t, '\d[\d,]*(?:\.\d+)?\s*(?:BBY|ABY)'), lambda x: lower(regexp_replace(x, '[,\s]', '', 'g'))))), ' ') as dates from d"""
)
def era_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    t = F.concat(F.lit("In "), (i % 97).cast("string"), F.lit(","), (100 + i % 800).cast("string"), F.lit(" BBY and "), (i % 40).cast("string"), F.lit("ABY "), F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.array_sort(T.era_dates(t)), " ").alias("dates"))


# Filters and gates ------------------------------------------------------------------------------

_LINES = "list_filter(string_split(md, chr(10)), lambda x: regexp_matches(x, '\\S'))"


@register(
    f"""select reason, count(*)::bigint as n from (select case when length(md) < 120 then 'too short'
      when len(list_filter({_LINES}, lambda x: regexp_matches(x, '^\\s*- '))) >= 5 and len(list_filter({_LINES}, lambda x: regexp_matches(x, '^\\s*- '))) > 0.5 * len({_LINES}) then 'index list' else 'keep' end as reason
      from {_pages_sql()}) group by reason"""
)
def skip_reason_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.coalesce(M.skip_reason("md", index_items=5), F.lit("keep"))
    return _pages_md(spark, sf_dir).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@register(
    f"""select page_id, len(list_filter({_LINES}, lambda x: regexp_matches(x, '^\\s*- ')))::int as items, len({_LINES})::int as lines,
      len(list_filter({_LINES}, lambda x: regexp_matches(x, '^\\s*- '))) >= 5 and len(list_filter({_LINES}, lambda x: regexp_matches(x, '^\\s*- '))) > 0.3 * len({_LINES}) as is_index from {_pages_sql()}"""
)
def index_list_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    solid = M.solid_lines("md")
    items = F.size(F.filter(solid, lambda x: x.rlike(r"\A\s*- ")))
    return _pages_md(spark, sf_dir).select("page_id", items.alias("items"), F.size(solid).alias("lines"), M.is_index_list("md", 5, 0.3).alias("is_index"))


_VIEWS = (
    G.View("inuniverse", min_body_chars=600, continuity=("en", "fr")), G.View("timeline", min_body_chars=800, require_pattern="tion of"), G.View("quiz", min_body_chars=250),
    G.View("summary", min_body_chars=600, max_out_ratio=0.6),
)


@register(
    """with v(view, least, tags, pattern) as (values ('inuniverse', 600, ['en', 'fr'], ''), ('timeline', 800, [], 'tion of'), ('quiz', 250, [], ''), ('summary', 600, [], ''))
    select view, reason, count(*)::bigint as n from (select view, case when length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) < 120 then 'too short' when length(t) < least then 'too short for view'
      when len(tags) > 0 and not list_contains(tags, lang) then 'continuity excluded' when pattern <> '' and not regexp_matches(t, concat('(?i)', pattern)) then 'pattern not found' else 'keep' end as reason
      from (select *, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as t from documents), v) group by view, reason"""
)
def view_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", M.strip("text").alias("body"))
    reasons = T.let(G.eligibility("body", "lang", _VIEWS), lambda r: F.array(*[F.struct(F.lit(v.name).alias("view"), F.coalesce(F.get(r, k), F.lit("keep")).alias("reason")) for k, v in enumerate(_VIEWS)]))
    return docs.select(F.explode(reasons).alias("r")).groupBy("r.view", "r.reason").agg(F.count("*").alias("n"))


_TURNS = "(select *, lag(role) over (partition by conv_id order by turn) as before, lag(text) over (partition by conv_id order by turn) as asked from conversations)"


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations")
    return turns.select("*", F.lag("role").over(w).alias("before"), F.lag("text").over(w).alias("asked")).where("role = 'assistant' and before = 'user'")


_DATES = r"list_distinct(list_transform(regexp_extract_all({0}, '\d[\d,]*(?:\.\d+)?\s*(?:BBY|ABY)'), lambda x: lower(regexp_replace(x, '[,\s]', '', 'g'))))"
_MADE_UP = f"list_sort(list_filter({_DATES.format('made')}, lambda d: not list_contains({_DATES.format('packed')}, d)))"


@register(
    f"""select conv_id, turn, coalesce(case when made = '' then 'empty response' when regexp_matches(made, '(?i)^\\s*(?:i (?:can''?t|cannot|won''?t|am unable)|as an ai|i''m sorry)') then 'refusal'
      when length(made) < 40 then concat('too short (', length(made), ' chars)') when length(made) / greatest(length(packed), 1) > 1.5 then concat('length ratio ', printf('%.2f', length(made) / greatest(length(packed), 1)))
      when length(title) > 3 and not contains(lower(made), lower(title)) then 'subject missing'
      when regexp_matches(made, '(?i)\\bas an ai\\b') then concat('meta-talk: ''', regexp_extract(made, '(?i)\\bas an ai\\b'), '''') when len({_MADE_UP}) > 0 then concat('date not in source: ', {_MADE_UP}[1]) end, 'keep') as reason
      from (select *, concat(text, case when conv_id % 3 > 0 then concat(' In ', conv_id % 9, ' BBY.') else '' end) as made, concat(asked, ' ', turn, ' BBY') as packed, regexp_extract(asked, '[A-Za-z0-9]+', 0) as title
        from {_TURNS} where role = 'assistant' and before = 'user')"""
)
def rewrite_gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each answer as a rewrite of what was asked, with a date added to both; the title is the first word asked."""
    view = G.View("turns", min_out_chars=40, forbid=(r"\bas an ai\b",))
    made = F.concat("text", F.when(F.col("conv_id") % 3 > 0, F.concat(F.lit(" In "), (F.col("conv_id") % 9).cast("string"), F.lit(" BBY."))).otherwise(""))
    packed = F.concat("asked", F.lit(" "), F.col("turn").cast("string"), F.lit(" BBY"))
    turns = _answers(spark, sf_dir).withColumns({"made": made, "packed": packed, "title": F.regexp_extract("asked", "[A-Za-z0-9]+", 0)})
    return turns.select("conv_id", "turn", F.coalesce(G.rewrite_reason("made", "packed", "title", view), F.lit("keep")).alias("reason"))


@register(
    f"""select conv_id, turn, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(text, '[0-9][0-9,.]*')), lambda n: not contains(asked, n))), ' ') as unsupported
      from {_TURNS} where role = 'assistant' and before = 'user'"""
)
def number_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.filter(F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9][0-9,.]*"), F.lit(0))), lambda n: ~F.contains(F.col("asked"), n))
    return _answers(spark, sf_dir).select("conv_id", "turn", F.array_join(F.array_sort(made), " ").alias("unsupported"))


@register(
    r"""select doc_id, regexp_matches(text, '(?i)\bthe available (?:information|data|sources?)\b|\bas an AI\b|\bmy (?:search|tools?)\b|\[\d+\]|\b(?:never (?:been )?(?:established|recorded))') as leaks,
      length(text) < 2 as empty, length(text) > 4000 as too_long from documents"""
)
def leak_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = r"(?i)\bthe available (?:information|data|sources?)\b|\bas an AI\b|\bmy (?:search|tools?)\b|\[\d+\]|\b(?:never (?:been )?(?:established|recorded))"
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").rlike(pattern).alias("leaks"), (F.char_length("text") < G.MIN_ANSWER_CHARS).alias("empty"), (F.char_length("text") > G.MAX_ANSWER_CHARS).alias("too_long"))


@register(None)
def answer_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All the patterns, some of which look ahead, which SQL's engine cannot."""
    reason = F.coalesce(G.answer_reason(G.strip_citations(G.strip_preamble("text")), 1), F.lit("keep"))
    return table(spark, sf_dir, "documents").select("doc_id", reason.alias("reason"))


@register(None)
def question_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each asked turn as a question, twice: its evidence is the answer, to be found in both turns, or the asked turn, to be found in the answer."""
    pair = lambda name, evidence, passage: F.struct(F.lit(name).alias("evidence"), evidence.alias("span"), passage.alias("passage"))
    spans = F.explode(F.array(pair("answer", F.col("text"), F.concat_ws("\n", "asked", "text")), pair("asked", F.col("asked"), F.col("text"))))
    turns = _answers(spark, sf_dir).withColumn("e", spans).select("conv_id", "turn", "asked", "e.*")
    return turns.select("conv_id", "turn", "evidence", F.coalesce(G.question_reason(F.concat("asked", F.lit("?")), "span", F.lit("the"), "passage"), F.lit("keep")).alias("reason"))


@register(None)
def unsupported_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).select("conv_id", "turn", F.array_join(G.unsupported_terms("text", "asked", F.lit(""), "asked"), "|").alias("terms"))


# Joins ------------------------------------------------------------------------------------------


@register("select item_id, doc_id from benchmark b join documents d on contains(d.text, b.text)")
def evidence_in_passage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return B.evidence_pairs(table(spark, sf_dir, "benchmark"), docs.withColumnRenamed("text", "passage"), "item_id", "text", "passage")


@register(
    """select d.doc_id, case when max(l.toxic) = 1 then 'canon' when max(l.quality) = 1 then 'legends' else 'real-world' end as continuity
      from documents d left join labels l on d.doc_id = l.doc_id group by d.doc_id"""
)
def continuity_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    members = labels.where("quality = 1").select("doc_id", F.lit("legends").alias("tag")).unionByName(labels.where("toxic = 1").select("doc_id", F.lit("canon").alias("tag")))
    return B.classify(table(spark, sf_dir, "documents").select("doc_id"), members, "doc_id")


@register("select source, count(*)::bigint as n from documents where doc_id not in (select doc_id from labels) group by source")
def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return B.outstanding(docs, table(spark, sf_dir, "labels").select("doc_id"), "doc_id").groupBy("source").agg(F.count("*").alias("n"))


@register(
    """select case when length(text) < 120 then 'too short' else 'todo' end as reason, count(*)::bigint as n, sum(n_chars)::bigint as chars from documents
      where doc_id not in (select doc_id from labels where quality = 1) and doc_id not in (select doc_id from labels where toxic = 1) group by 1"""
)
def outstanding_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    left = B.outstanding(table(spark, sf_dir, "documents"), labels.where("quality = 1").select("doc_id"), "doc_id", labels.where("toxic = 1").select("doc_id"))
    return left.groupBy(F.when(F.char_length("text") < 120, "too short").otherwise("todo").alias("reason")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@register(
    """with v(view) as (values ('quiz'), ('summary')) select view, count(*)::bigint as n from (select d.doc_id, v.view from documents d, v
      where not exists (select 1 from labels l where l.doc_id = d.doc_id and v.view = case when l.quality = 1 then 'quiz' else 'summary' end)) group by view"""
)
def view_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = spark.createDataFrame([("quiz",), ("summary",)], "view string")
    done = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "quiz").otherwise("summary").alias("view"))
    return B.work_list(table(spark, sf_dir, "documents").select("doc_id"), views, done).groupBy("view").agg(F.count("*").alias("n"))


@register("select source, count(*)::bigint as documents, count(l.doc_id)::bigint as labelled, round(count(l.doc_id) / count(*), 6) as fraction from documents d left join labels l on d.doc_id = l.doc_id group by source")
def answered_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("hit")), "doc_id", "left")
    return joined.groupBy("source").agg(F.count("*").alias("documents"), F.count("hit").alias("labelled"), F.round(F.count("hit") / F.count("*"), 6).alias("fraction"))


@register("select e.event_id, o.o_orderkey as owner from (select *, event_id * 13 as at from events) e asof join orders o on e.at >= o.o_orderkey")
def offset_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") * 13).alias("at"))
    return B.owner_of(events, table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("start"))).select("event_id", F.col("start").alias("owner"))


# Reports ----------------------------------------------------------------------------------------


@register(
    """with s as (select source, count(*)::bigint as documents, sum(strlen(text))::bigint as bytes from documents group by source),
    a as (select * from s union all select 'total', sum(documents)::bigint, sum(bytes)::bigint from s) select *, floor(bytes / 3.6)::bigint as tokens from a"""
)
def inventory_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.inventory(table(spark, sf_dir, "documents"))


@register(
    """select 'role' as field, role as value, count(*)::bigint as records, count(distinct conv_id)::bigint as sources from conversations group by role
      union all select 'turn', turn::varchar, count(*)::bigint, count(distinct conv_id)::bigint from conversations group by turn"""
)
def jsonl_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.histograms(table(spark, sf_dir, "conversations"), ["role", "turn"], "conv_id")


_ERRORS = "concat(case when user_id % 5 = 0 then 'http 402' when event_type = 'error' then 'timeout' else concat('rejected ', event_type) end, ': ', event_id)"


@register(
    f"""select left(split_part(e, ':', 1), 40) as reason, count_if(not regexp_matches(e, '^http (?:401|402|403|404)\\b'))::bigint as failures,
      count(distinct case when not regexp_matches(e, '^http (?:401|402|403|404)\\b') then user_id end)::bigint as items, count_if(regexp_matches(e, '^http (?:401|402|403|404)\\b'))::bigint as ignored
      from (select user_id, {_ERRORS} as e from events) group by 1"""
)
def ledger_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("user_id") % 5 == 0, "http 402").when(F.col("event_type") == "error", "timeout").otherwise(F.concat(F.lit("rejected "), "event_type"))
    return B.ledger_report(table(spark, sf_dir, "events").select("user_id", F.concat(kind, F.lit(": "), F.col("event_id").cast("string")).alias("e")), "user_id", "e")


@register(
    """with c as (select lang, count(*)::bigint as n from documents group by lang) select lang, n, round(100.0 * n / (select sum(n) from c), 4)::double as share from c
      union all select 'total', sum(n)::bigint, 100.0 from c"""
)
def manifest_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.shares(table(spark, sf_dir, "documents"), "lang")


@register("select value, n from (select event_type as value, count(*)::bigint as n from events group by event_type) order by n desc, value limit 4")
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.top_values(table(spark, sf_dir, "events"), "event_type")


@register(
    """with r as (select conv_id * 1000 + turn as id, case when length(text) < 60 then concat('short: ', length(text)) when role = 'system' then 'role: system' end as reason from conversations)
    select id, reason, split_part(reason, ':', 1) as kind, nth::int as nth from (select *, row_number() over (partition by split_part(reason, ':', 1) order by id) as nth from r where reason is not null) where nth <= 40"""
)
def reject_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.when(F.char_length("text") < 60, F.concat(F.lit("short: "), F.char_length("text").cast("string"))).when(F.col("role") == "system", "role: system")
    return B.reject_samples(table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), reason.alias("reason")), "reason", "id").select("id", "reason", "kind", "nth")


@register("select doc_id from (select doc_id from documents order by md5(concat('1977/', doc_id)), doc_id limit 100)")
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Just a hundred rows: the feature is an exact, repeatable sample."""
    return B.exact_sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100)


@register(
    """with p as (select lang as view, count(*)::bigint as requests, sum(n_chars)::bigint as chars from documents group by lang),
    q as (select view, requests, chars, chars / 3.6 + requests * 500 / 3.6 + 20 * requests as tokens_in, chars * 0.5 / 3.6 as tokens_out from p),
    a as (select * from q union all select 'TOTAL', sum(requests)::bigint, sum(chars)::bigint, sum(tokens_in), sum(tokens_out) from q)
    select view, requests, chars, round(tokens_in::double, 3) as tokens_in, round(tokens_out::double, 3) as tokens_out, round((tokens_in::double * 0.14 + tokens_out::double * 0.28) / 1e6, 6) as cost from a"""
)
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = B.estimate(table(spark, sf_dir, "documents").withColumnRenamed("lang", "view"), "view", "n_chars", prompt_chars=500, out_ratio=0.5)
    return e.select("view", "requests", "chars", F.round("tokens_in", 3).alias("tokens_in"), F.round("tokens_out", 3).alias("tokens_out"), F.round("cost", 6).alias("cost"))


@register("select source, done, todo, case when todo > 0 then least(100.0 * done / (done + todo), 99.9) else 100.0 end::double as share from (select source, count(l.doc_id)::bigint as done, (count(*) - count(l.doc_id))::bigint as todo from documents d left join labels l on d.doc_id = l.doc_id group by source)")
def progress_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("hit")), "doc_id", "left")
    counts = joined.groupBy("source").agg(F.count("hit").alias("done"), F.count_if(F.col("hit").isNull()).alias("todo"))
    return counts.withColumn("share", B.progress(F.col("done"), F.col("todo")))


@register("select day, n, round((n - lag(n) over (order by day)) / 86400.0, 9)::double as rate from (select ts::date as day, count(*)::bigint as n from events group by 1)")
def events_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return B.rate_between(daily, "day", "n").withColumn("rate", F.round("rate", 9))


# Articles and packaging -------------------------------------------------------------------------


@register(
    """select doc_id, concat('# Document ', doc_id, chr(10), chr(10), '*', source, case lang when 'en' then ' · Canon' when 'de' then ' · Legends' else '' end, '*', chr(10), chr(10), regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10)) as text,
      concat('https://example.org/wiki/', replace(concat('Document ', doc_id), ' ', '_')) as url, 'CC BY-SA 3.0' as license from documents where regexp_matches(text, '\\S')"""
)
def pretrain_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.operators.package import attribution_url, training_text

    docs = table(spark, sf_dir, "documents").where(F.col("text").rlike(r"\S")).withColumn("title", F.concat(F.lit("Document "), F.col("doc_id").cast("string")))
    tag = F.when(F.col("lang") == "en", "canon").when(F.col("lang") == "de", "legends")
    return docs.select("doc_id", training_text(F.col("title"), F.col("source"), tag, F.lit(""), F.col("text")).alias("text"), attribution_url(F.col("title"), "https://example.org/wiki/").alias("url"), F.lit("CC BY-SA 3.0").alias("license"))


@register(f"select conv_id, turn, concat('system: You know.', chr(10), 'user: ', asked, chr(10), 'assistant: ', text) as messages, 0::int as tools, 'other' as type from {_TURNS} where role = 'assistant' and before = 'user'")
def sft_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.operators.package import sft_rows

    rows = sft_rows(_answers(spark, sf_dir).select("conv_id", "turn", F.col("asked").alias("q"), F.col("text").alias("a"), F.lit("other").alias("type")), "You know.")
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
    return rows.select("conv_id", "turn", said.alias("messages"), "tools", "type")


@register(
    """with recursive t as (select source, doc_id, strlen(text)::bigint as bytes, row_number() over (partition by source order by doc_id) as i from documents),
    r as (select source, doc_id, bytes, i, 0 as shard, bytes as held from t where i = 1 union all
      select t.source, t.doc_id, t.bytes, t.i, case when r.held >= 20000 then r.shard + 1 else r.shard end, case when r.held >= 20000 then 0 else r.held end + t.bytes from r join t on t.source = r.source and t.i = r.i + 1)
    select source, doc_id, bytes, shard::int as shard from r"""
)
def greedy_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return H.greedy_shards(docs, "source", "doc_id", H.row_bytes(docs), 20_000)


@register(
    """with recursive t as (select source, doc_id, strlen(text)::bigint as bytes, row_number() over (partition by source order by doc_id) as i from documents),
    r as (select source, doc_id, bytes, i, 0 as shard, bytes as held from t where i = 1 union all
      select t.source, t.doc_id, t.bytes, t.i, case when r.held >= 20000 then r.shard + 1 else r.shard end, case when r.held >= 20000 then 0 else r.held end + t.bytes from r join t on t.source = r.source and t.i = r.i + 1)
    select source, count(*)::bigint as rows, count(distinct shard)::bigint as files, sum(bytes)::bigint as raw_bytes from r group by source"""
)
def shard_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return H.shard_stats(H.greedy_shards(docs, "source", "doc_id", H.row_bytes(docs), 20_000))


@register(f"select page_id, md, length(md)::int as chars from {_pages_sql()}")
def html_to_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_md(spark, sf_dir).select("page_id", "md", F.char_length("md").alias("chars"))


@register(
    "select page_id, regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '(?is)<strong\\b[^>]*>(.*?)</strong>', '**\\1**', 'g'), '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&'), '(?m)^[-*]\\s*$\\n?', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g') as cleaned from pages"
)
def html_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", M.clean_noise("html").alias("cleaned"))


@register(None)
def boilerplate_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_md(spark, sf_dir).select("page_id", M.strip_boilerplate("md").alias("kept"))


@register("select page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1))), ' ') as links from pages")
def links_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))), " ").alias("links"))


@register(
    """with recursive s as (select doc_id, unnest(p) as t, generate_subscripts(p, 1) as i from (select doc_id, string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)) as p from documents)),
    r as (select doc_id, i, 0 as chunk, length(t) + 2 as size from s where i = 1 union all
      select s.doc_id, s.i, case when r.size + length(s.t) > 1500 then r.chunk + 1 else r.chunk end, case when r.size + length(s.t) > 1500 then 0 else r.size end + length(s.t) + 2 from r join s on s.doc_id = r.doc_id and s.i = r.i + 1)
    select doc_id, chunk::int as chunk, count(*)::bigint as paragraphs, sum(length(t))::bigint + 2 * (count(*) - 1) as chars from r join s using (doc_id, i) group by doc_id, chunk"""
)
def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines as the paragraphs of one section."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(M.pack_paragraphs(F.replace("text", F.lit("\n"), F.lit("\n\n")), 1500)).alias("chunk", "t"))
    return docs.select("doc_id", "chunk", F.size(F.split("t", "\n\n", -1)).cast("long").alias("paragraphs"), F.char_length("t").cast("long").alias("chars"))


@register(None)
def article_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of page articles at a small limit, with the context that each is given."""
    from pyspark.sql import Window

    rows = _pages_md(spark, sf_dir).select("page_id", F.posexplode(M.chunks("md", 1500)).alias("chunk", "text"))
    before = F.lag("text").over(Window.partitionBy("page_id").orderBy("chunk"))
    return rows.withColumn("before", before).select("page_id", "chunk", "text", M.chunk_context(F.col("before"), F.col("text")).alias("context"))


@register(None)
def condense_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_md(spark, sf_dir).select("page_id", M.condense("md", 800).alias("condensed"))


@register(None)
def empty_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages_md(spark, sf_dir).select("page_id", M.strip_empty_sections("md").alias("body"))


from textloom import queries_articles, queries_questions  # noqa: E402, F401  (they register their queries here)
