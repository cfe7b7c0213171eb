"""Registered queries of question and answer operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import markdown as M
from textloom.functions import text as T
from textloom.operators import gates as G
from textloom.operators import package as P
from textloom.operators import questions as Q
from textloom.operators import tables as B
from textloom.queries import _STRIP, _TURNS, _WORDS, _answers, register
from textloom.session import table

_SHARE = "concat('0x', substr(sha1({0}), 1, 8))::bigint / 4294967296.0"

# Each turn as a question record: kinds, continuities and splits from numbers, some of them missing.
_RECORDS = f"""(select conv_id, turn, conv_id * 1000 + turn as id, case when turn = 3 then '' else text end as q, ['factoid', 'numeric', 'date', 'open'][1 + conv_id % 4] as type, ['canon', 'legends', null][1 + turn % 3] as continuity,
    concat('src', conv_id % 7, '/', conv_id % 50, '.md') as source, case when conv_id % 5 = 0 then 'eval' when conv_id % 5 = 1 then 'train' end as named from conversations)"""
_CHOSEN = f"(select *, coalesce(named, case when {_SHARE.format('source')} < 0.1 then 'eval' else 'train' end) as split from {_RECORDS} where q <> '')"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = F.col("conv_id"), F.col("turn")
    split = F.when(c % 5 == 0, "eval").when(c % 5 == 1, "train")
    pick = lambda n, *x: F.get(F.array(*[F.lit(y).cast("string") for y in x]), n.cast("int"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", (c * 1000 + t).alias("id"), F.when(t == 3, "").otherwise(F.col("text")).alias("q"), pick(c % 4, "factoid", "numeric", "date", "open").alias("type"), pick(t % 3, "canon", "legends", None).alias("continuity"),
        F.concat(F.lit("src"), (c % 7).cast("string"), F.lit("/"), (c % 50).cast("string"), F.lit(".md")).alias("source"), split.alias("split"),
    )


@register(f"select id, source, split from {_CHOSEN} where type in ('factoid', 'date') and continuity in ('canon', 'legends') and split = 'train'")
def question_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.select_questions(_records(spark, sf_dir), ("factoid", "date"), ("canon", "legends"), ("train",), 0.1).select("id", "source", "split")


@register(f"select row_number() over (order by source, q, id) as place, id, source from (select * from {_CHOSEN} order by md5(concat('1977/', id)), id limit 60)")
def question_sample_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of sixty, then in the order of articles: the feature is the sample and its order."""
    from pyspark.sql import Window

    chosen = Q.select_questions(_records(spark, sf_dir), fraction=0.1, sample=60, order="id")
    return chosen.select(F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("source", "q", "id")).cast("long").alias("place"), "id", "source")


# Articles for questions: some paths have none.
_READ = "(select concat('src', doc_id % 7, '/', doc_id % 50, '.md') as path, concat('Doc ', doc_id) as title, text from documents where doc_id < 350 and doc_id % 7 <> 3)"


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    path = F.concat(F.lit("src"), (d % 7).cast("string"), F.lit("/"), (d % 50).cast("string"), F.lit(".md"))
    return table(spark, sf_dir, "documents").where((d < 350) & (d % 7 != 3)).select(path.alias("path"), F.concat(F.lit("Doc "), d.cast("string")).alias("title"), "text")


_NAMES = "coalesce(nullif(array_to_string(regexp_extract_all(text, '(?m)^## (.+)$', 1), ', '), ''), '(none)')"
_TRUNCATED = (
    "case when length(text) <= {0} then text else concat(substr(text, 1, {0}), chr(10), chr(10), '[truncated at {0} of ', length(text), ' characters. Sections you can recall: ', " + _NAMES
    + ", '. Call read_article again with `section` to read one of them in full.]') end"
)


@register(f"select q.id, q.source, r.title, case when r.path is not null then md5(concat('# ', r.title, chr(10), chr(10), {_TRUNCATED.format(14000)})) end as seed from {_CHOSEN} q left join {_READ} r on q.source = r.path")
def question_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.with_seed(Q.select_questions(_records(spark, sf_dir), fraction=0.1), _read(spark, sf_dir)).select("id", "source", "title", F.md5("seed").alias("seed"))


@register(
    f"""select q.id, concat('assistant  read_article ', '{{"title":"', r.title, '"}}', chr(10), 'tool ', md5(concat('# ', r.title, chr(10), chr(10), {_TRUNCATED.format(14000)})), ' read_article ') as messages
      from {_CHOSEN} q join {_READ} r on q.source = r.path"""
)
def seed_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions whose article is there, with the call and result they start from; results as digests."""
    seeded = Q.with_seed(Q.select_questions(_records(spark, sf_dir), fraction=0.1), _read(spark, sf_dir), require=True)
    line = lambda m: F.concat_ws(" ", m["role"], F.when(m["content"] == "", "").otherwise(F.md5(m["content"])), m["tool"], F.coalesce(m["arguments"], F.lit("")))
    return seeded.select("id", F.array_join(F.transform(Q.seed_messages("title", "seed"), line), "\n").alias("messages"))


@register(f"select split, id from (select id, coalesce(named, 'train') as split, row_number() over (partition by coalesce(named, 'train') order by id) as n from {_RECORDS}) where n <= 150")
def split_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 150 of each split: the feature is the limit."""
    return Q.by_split(_records(spark, sf_dir), "id", 150).select("split", "id")


# Answers with phrases of all kinds put before or after a document's text.
_PHRASES = (
    "", "As an AI I think. ", "According to the text, ", "Okay, so. ", "You're right. ", "I have found it. ", "The available data tell. ", "Let me answer. ", "It was never recorded. ", "My search says. ",
    "The infobox shows. ", "See [12]. ", "Based on the passage, ", "Good! ", "Now I have it. ",
)
_LIST = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in _PHRASES) + "]"
_SAID = f"concat(({_LIST})[1 + doc_id % {len(_PHRASES)}], case when doc_id % 3 = 0 then substr(text, 1, 60) else text end, case when doc_id % 11 = 0 then concat(chr(10), chr(10), 'Sources: a, b') else '' end)"


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short answers are made of the first 60 characters of a text, long ones of all of it."""
    d = F.col("doc_id")
    phrase = F.get(F.array(*map(F.lit, _PHRASES)), (d % len(_PHRASES)).cast("int"))
    said = F.concat(phrase, F.when(d % 3 == 0, F.substring("text", 1, 60)).otherwise(F.col("text")), F.when(d % 11 == 0, "\n\nSources: a, b").otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", said.alias("said"))


# One pattern looks ahead, which this SQL cannot; sites are another parameter.
_PLAIN_LEAKS = tuple(p for p in G.LEAKS if "(?!" not in p)


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''").replace(r"\A", "^").replace(r"\z", "$")


_PRE = f"trim(regexp_replace(said, '(?i){_quoted(G.PREAMBLE)}', ''), ' ')"
_KEPT = f"case when {_PRE} <> said and length({_PRE}) >= {G.MIN_KEPT_CHARS} then {_PRE} else said end"
_CITED = _STRIP.format(f"regexp_replace(pre, '{_quoted(G.TRAILING_SOURCES)}', '')")
_CLEANED = f"(select doc_id, {_CITED} as a from (select doc_id, {_KEPT} as pre from (select doc_id, {_SAID} as said from documents)))"


@register(f"select doc_id, md5(a) as kept, length(a)::int as chars from {_CLEANED}")
def answer_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = G.strip_citations(G.strip_preamble("said"))
    return _said(spark, sf_dir).select("doc_id", F.md5(kept).alias("kept"), F.char_length(kept).alias("chars"))


_LEAK = "regexp_extract(a, '(?im)" + "|".join(map(_quoted, (r"\bexample wiki\b", *_PLAIN_LEAKS))) + "', 0)"
_ANSWER_REASON = f"""coalesce(case when length(a) < 2 then 'empty answer' when length(a) > 4000 then 'answer too long' when doc_id % 13 = 0 then 'no tools used'
      when {_LEAK} <> '' then concat('persona leak: ', substr(lower({_STRIP.format(_LEAK)}), 1, 40)) when length(a) <= 240 and regexp_matches(a, '(?i){_quoted(G.DECLINES)}') then 'declined a recorded fact' end, 'keep')"""


def _reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = _said(spark, sf_dir).select("doc_id", G.strip_citations(G.strip_preamble("said")).alias("a"))
    return answers.select("doc_id", G.answer_reason("a", (F.col("doc_id") % 13).cast("int"), leaks=_PLAIN_LEAKS, sites=("example wiki",)).alias("reason"))


@register(f"select doc_id, {_ANSWER_REASON} as reason from {_CLEANED}")
def answer_gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(spark, sf_dir).select("doc_id", F.coalesce("reason", F.lit("keep")).alias("reason"))


@register(f"select substr(r, 15) as phrase, count(*)::bigint as n from (select {_ANSWER_REASON} as r from {_CLEANED}) where starts_with(r, 'persona leak: ') group by 1 order by n desc, phrase limit 5")
def leak_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.top_leaks(_reasons(spark, sf_dir))


@register(f"select kind, n, round(n / total, 9) as rate from (select split_part(r, ':', 1) as kind, count(*)::bigint as n, sum(count(*)) over () as total from (select {_ANSWER_REASON} as r from {_CLEANED}) group by 1) where kind <> 'keep'")
def reject_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.reject_rates(_reasons(spark, sf_dir)).withColumn("rate", F.round("rate", 9))


_FOLD = _STRIP.format("regexp_replace(lower(replace(replace({0}, '*', ''), '_', ' ')), '\\s+', ' ', 'g')")


@register(
    f"""select conv_id, turn, coalesce(case when not ends_with(q, '?') then 'not a question' when length(q) not between 15 and 300 then 'length'
      when regexp_matches(q, '(?i){_quoted(G.META)}') or regexp_matches(e, '(?i){_quoted(G.META)}') then 'meta-reference' when e = '' then 'no evidence' when length({_FOLD.format('e')}) < 20 then 'evidence too short'
      when not contains({_FOLD.format('p')}, {_FOLD.format('e')}) then 'evidence not in passage'
      when regexp_matches(q, '(?i){_quoted(G.PRONOUN_OPENING)}') and not regexp_matches(substr(q, 2), '\\b[A-Z][A-Za-z0-9''\\-]{{2,}}') then 'pronoun subject' end, 'keep') as reason
      from (select conv_id, turn, concat(['', 'Why did they go, ', 'Who in the passage said ', 'What of it, '][1 + conv_id % 4], substr(asked, 1, 40), case when turn % 5 = 1 then '' else '?' end) as q,
        case conv_id % 6 when 0 then '' when 1 then 'short one' when 2 then asked else concat('  ', split_part(text, '. ', 2), ' ') end as e, text as p from {_TURNS} where role = 'assistant' and before = 'user')"""
)
def question_gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions made of the first 40 characters asked, since longer ones fail by length alone; evidence is the answer's second sentence, or none of it."""
    c = F.col("conv_id")
    q = F.concat(F.get(F.array(*map(F.lit, ("", "Why did they go, ", "Who in the passage said ", "What of it, "))), (c % 4).cast("int")), F.substring("asked", 1, 40), F.when(F.col("turn") % 5 == 1, "").otherwise("?"))
    e = F.when(c % 6 == 0, "").when(c % 6 == 1, "short one").when(c % 6 == 2, F.col("asked")).otherwise(F.concat(F.lit("  "), F.split_part("text", F.lit(". "), F.lit(2)), F.lit(" ")))
    rows = _answers(spark, sf_dir).select("conv_id", "turn", q.alias("q"), e.alias("e"), "text")
    return rows.select("conv_id", "turn", F.coalesce(G.question_reason("q", "e", F.lit(""), "text", terms=False), F.lit("keep")).alias("reason"))


@register(
    f"""select conv_id, turn, coalesce(case when made = '' then 'empty response' when regexp_matches(made, '(?i){_quoted(G.REFUSAL)}') then 'refusal' when turn = 5 then 'truncated'
      when length(made) / greatest(length(asked), 1) < 0.55 or length(made) / greatest(length(asked), 1) > 2.0 then 'length ratio'
      when len(regexp_extract_all(made, '(?m)^#{{2,6}} .*$')) < len(regexp_extract_all(asked, '(?m)^#{{2,6}} .*$')) then 'headings lost' end, 'keep') as reason
      from (select conv_id, turn, case when conv_id % 8 = 0 then concat('I cannot do that. ', text) when conv_id % 8 = 1 then asked else text end as made, case when conv_id % 4 = 2 then concat('## Part', chr(10), asked) else asked end as asked
        from {_TURNS} where role = 'assistant' and before = 'user')"""
)
def chunk_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunked(spark, sf_dir).select("conv_id", "turn", F.coalesce("reason", F.lit("keep")).alias("reason"))


def _chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("conv_id")
    made = F.when(c % 8 == 0, F.concat(F.lit("I cannot do that. "), "text")).when(c % 8 == 1, F.col("asked")).otherwise(F.col("text"))
    asked = F.when(c % 4 == 2, F.concat(F.lit("## Part\n"), "asked")).otherwise(F.col("asked"))
    rows = _answers(spark, sf_dir).select("conv_id", "turn", made.alias("made"), asked.alias("asked"))
    return rows.withColumn("reason", G.chunk_reason("made", "asked", F.when(F.col("turn") == 5, "length").otherwise("stop")))


@register(
    """with s as (select conv_id, length(text) as n, turn % 4 > 0 as sent, turn % 4 = 1 or (conv_id % 3 = 0 and turn % 4 = 3) as failed from conversations)
    select conv_id, round(sum(case when failed and sent then n else 0 end) / greatest(sum(case when sent then n else 0 end), 1), 9) as share,
      sum(case when failed and sent then n else 0 end) / greatest(sum(case when sent then n else 0 end), 1) > 0.5 as rejected from s group by conv_id"""
)
def degradation_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, c = F.col("turn"), F.col("conv_id")
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.char_length("text").alias("n"), (t % 4 > 0).alias("sent"), ((t % 4 == 1) | ((c % 3 == 0) & (t % 4 == 3))).alias("failed"))
    return G.degraded(turns, "conv_id", "failed", "n", "sent").withColumn("share", F.round("share", 9))


@register(
    f"""with r as (select *, array_to_string({_WORDS.format('q')}, ' ') as key from {_RECORDS}), a as (select distinct key from r where conv_id % 2 = 0)
    select r.source, count(*)::bigint as n, count(a.key)::bigint as answered from r left join a using (key) group by r.source"""
)
def answered_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    done = B.answered(records, records.where("conv_id % 2 = 0").select("q"))
    return done.groupBy("source").agg(F.count("*").alias("n"), F.count_if("answered").alias("answered"))


@register(
    f"""with r as (select *, array_to_string({_WORDS.format('q')}, ' ') as key from {_RECORDS}), a as (select distinct key from r where conv_id % 2 = 0)
    select count(*)::bigint as records, count(distinct source)::bigint as sources, round(100 * avg((a.key is not null)::int), 4) as answered, (select count(distinct path) from {_READ})::bigint as articles,
      round(100 * count(distinct source) / (select count(distinct path) from {_READ}), 4) as covered from r left join a using (key)"""
)
def question_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    return B.coverage(records, _read(spark, sf_dir).select(F.col("path").alias("source")), records.where("conv_id % 2 = 0").select("q"))


_REPLY = "concat(case when doc_id % 4 = 0 then '```' else '' end, chr(10), '1. factoid | What is ', doc_id, '? | \"', split_part(text, '. ', 1), '\"', chr(10), chr(10), '- Open | Why so?', chr(10), 'Just a line', chr(10), '• Where, then? | some evidence', case when doc_id % 4 = 0 then concat(chr(10), '```') else '' end)"


@register(
    f"""with l as (select doc_id, {_STRIP.format("regexp_replace(x, '^\\s*(?:[-*•]|[0-9]+[.)])\\s*', '')")} as x, i from (select doc_id, unnest(p) as x, generate_subscripts(p, 1) as i
        from (select doc_id, string_split(regexp_replace({_STRIP.format(_REPLY)}, '(?s)^```[a-z]*\\s*\\n(.*)\\n```\\s*$', '\\1'), chr(10)) as p from documents))),
      f as (select doc_id, i, list_transform(case when len(string_split(x, '|')) > 3 then [split_part(x, '|', 1), split_part(x, '|', 2), array_to_string(string_split(x, '|')[3:], '|')] else string_split(x, '|') end, lambda y: {_STRIP.format('y')}) as p from l where x <> ''),
      k as (select *, len(p) as n, lower(p[1]) in ({', '.join(f"'{t}'" for t in G.QUESTION_TYPES)}) as known from f)
    select doc_id, (row_number() over (partition by doc_id order by i) - 1)::int as place, case when n > 1 and known then lower(p[1]) else 'other' end as kind,
      {_STRIP.format("trim(case when n = 3 then p[2] when n = 2 and known then p[2] else p[1] end, '\"')")} as question, {_STRIP.format("trim(case when n = 3 then p[3] when n = 2 and not known then p[2] else '' end, '\"')")} as evidence from k"""
)
def parsed_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's reply for each document: numbers, bullets, fences, missing fields, unknown kinds."""
    d, fence = F.col("doc_id"), F.col("doc_id") % 4 == 0
    reply = F.concat(
        F.when(fence, "```").otherwise(""), F.lit("\n1. factoid | What is "), d.cast("string"), F.lit('? | "'), F.split_part("text", F.lit(". "), F.lit(1)), F.lit('"\n\n- Open | Why so?\nJust a line\n• Where, then? | some evidence'),
        F.when(fence, "\n```").otherwise(""),
    )
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(G.parse_questions(reply)).alias("place", "r"))
    return rows.select("doc_id", "place", "r.kind", "r.question", "r.evidence")


@register(f"select id, q, type, continuity, source as source_article, null::varchar as evidence from {_RECORDS}")
def question_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = P.question_rows(_records(spark, sf_dir).drop("id").withColumn("id", F.col("conv_id") * 1000 + F.col("turn")))
    keyed = _records(spark, sf_dir).select("id", "q", "type", "continuity", F.col("source").alias("source_article"))
    return keyed.join(rows.distinct(), [keyed.q.eqNullSafe(rows.q), keyed.type.eqNullSafe(rows.type), keyed.continuity.eqNullSafe(rows.continuity), keyed.source_article.eqNullSafe(rows.source_article)]).select(keyed["*"], rows.evidence)


@register(
    """with e as (select *, case when kept >= 0.4 * asked then attempt end as enough from (select user_id, (event_id // 60) % 5 as attempt, sum((value > 20)::int) as kept, count(*) as asked from events group by 1, 2))
    select user_id, coalesce(min(enough), arg_max(attempt, kept * 10 - attempt)) as attempt from e group by user_id"""
)
def best_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    attempts = table(spark, sf_dir, "events").groupBy("user_id", F.expr("(event_id div 60) % 5").alias("attempt")).agg(F.sum((F.col("value") > 20).cast("int")).alias("kept"), F.count("*").alias("asked"))
    return G.best_batch(attempts, "user_id", "attempt", "kept", "asked")


@register(f"select count(*)::bigint as requests, sum(length(text))::bigint as chars, sum(greatest(2, least(12, length(text) // 700)))::bigint as wanted, round(count(*) * 1000 / 3.6, 6)::double as cached, "
    "round(sum(length(text)) / 3.6 + count(*) * 1000 / 3.6 + count(*) * 25, 6)::double as tokens_in, (sum(greatest(2, least(12, length(text) // 700))) * 50)::double as tokens_out, "
    "round(((sum(length(text)) / 3.6 + count(*) * 25) * 0.14 + count(*) * 1000 / 3.6 * 0.0028 + sum(greatest(2, least(12, length(text) // 700))) * 50 * 0.28) / 1e6, 9)::double as cost from documents")  # fmt: skip
def question_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Q.question_estimate(table(spark, sf_dir, "documents"), "text", 1000)
    return e.select("requests", "chars", "wanted", F.round("cached", 6).alias("cached"), F.round("tokens_in", 6).alias("tokens_in"), "tokens_out", F.round("cost", 9).alias("cost"))


@register(
    f"""with q as (select r.*, least(coalesce(octet_length(encode(a.text)), 0), 14000) as size from {_RECORDS} r left join {_READ} a on r.source = a.path),
    s as (select count(*)::bigint as questions, count(*) filter (size = 0)::bigint as missing, sum(size)::bigint as seed_chars, sum(length(q))::bigint as chars from q), b as (select *, (questions * 2000 + seed_chars + chars) / 3.6 as base, questions * 2000 / 3.6 as cached from s),
    t as (select *, base + 0.6 * (base + questions * 7000 / 3.6) as tokens_in, questions * 1.6 * 600 / 3.6 as tokens_out from b)
    select questions, missing, seed_chars, round(tokens_in::double, 4) as tokens_in, round(cached::double, 4) as cached, round(tokens_out::double, 4) as tokens_out, round((((tokens_in - cached) * 0.14 + cached * 0.0028 + tokens_out * 0.28) / 1e6)::double, 8) as cost from t"""
)
def answer_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Q.answer_estimate(_records(spark, sf_dir), _read(spark, sf_dir), 2000)
    return e.select("questions", "missing", "seed_chars", *[F.round(c, 4).alias(c) for c in ("tokens_in", "cached", "tokens_out")], F.round("cost", 8).alias("cost"))


@register(
    """with k as (select concat('source ', n_nationkey) as name, 'CC BY-SA' as license, n_regionkey = 2 as restricted, null::varchar as derived_from from nation
      union all select concat('view ', r_regionkey), 'CC BY-SA', false, 'source 0' from region) select name, license, restricted, derived_from from k where not restricted"""
)
def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = table(spark, sf_dir, "nation").select(F.concat(F.lit("source "), F.col("n_nationkey").cast("string")).alias("name"), F.lit("CC BY-SA").alias("license"), (F.col("n_regionkey") == 2).alias("restricted"), F.lit(None).cast("string").alias("derived_from"))
    views = table(spark, sf_dir, "region").select(F.concat(F.lit("view "), F.col("r_regionkey").cast("string")).alias("name"), F.lit("CC BY-SA").alias("license"), F.lit("source 0").alias("derived_from"))
    return Q.select_sources(Q.registry(sources, views))


@register("select v.view, coalesce(n, 0)::bigint as n from (select concat('view ', r_regionkey) as view from region) v left join (select concat('view ', user_id % 4) as view, count(*) as n from events where event_type <> 'error' group by 1) o using (view)")
def written_per_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = table(spark, sf_dir, "region").select(F.concat(F.lit("view "), F.col("r_regionkey").cast("string")).alias("view"))
    return B.written_per_view(views, table(spark, sf_dir, "events").where("event_type <> 'error'").select(F.concat(F.lit("view "), (F.col("user_id") % 4).cast("string")).alias("view")))


@register("select event_type, user_id % 3 as view, count(*)::bigint as n from events group by 1, 2")
def tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.tallies(table(spark, sf_dir, "events").withColumn("view", F.col("user_id") % 3), "event_type", "view")


@register(
    """select doc_id, case when doc_id % 4 = 0 then concat('legacy/', doc_id) when doc_id % 3 > 0 then concat('base/', source, '/', doc_id) end as derived_from from documents"""
)
def derived_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(d % 4 == 0, F.concat(F.lit("legacy/"), d.cast("string"))).otherwise("").alias("explicit"), "source", F.when(d % 3 > 0, "base").alias("mirrored"), F.concat_ws("/", "source", d.cast("string")).alias("path"))
    return B.derived_from(docs, "explicit", "source", "mirrored", "path").select("doc_id", "derived_from")
