"""Questions chosen for answering, what they are given to read, their splits, and reports on answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import markdown as M
from textloom.functions import text as T
from textloom.operators.search import ARTICLE_CHARS
from textloom.operators.tables import RATES, exact_sample, unknown_names

# Fixed values of the size estimates.
SYSTEM_TOKENS = {"paraphrase": 20, "questions": 25}
TOKENS_PER_QUESTION, ANSWER_CHARS, EXTRA_ROUNDS, TOOL_CHARS, THINKING = 50, 600, 0.6, 7000, 5.6
TOP_LEAKS = 5
MIN_CONVERTED_CHARS = 200


def select_questions(
    records: DataFrame, types: tuple[str, ...] = (), continuities: tuple[str, ...] = (), splits: tuple[str, ...] = (), fraction: float = T.EVAL_FRACTION, sample: int | None = None, limit: int | None = None, order: str = "q"
) -> DataFrame:
    """Records with a question and a source, of these kinds; a missing split is that of the source's path.

    A sample is exact and drawn from all that fit; a limit takes the first by ``order``. The result is
    ordered by source and question, so that what one article needs is read once.
    """
    made = records.where((F.coalesce(F.col("q"), F.lit("")) != "") & (F.coalesce(F.col("source"), F.lit("")) != "")).withColumn("split", F.coalesce("split", T.assign_split("source", fraction)))
    for column, wanted in (("type", types), ("continuity", continuities), ("split", splits)):
        if wanted:
            made = made.where(F.coalesce(F.col(column).isin(*wanted), F.lit(False)))
    if sample:
        made = exact_sample(made, order, sample)
    elif limit:
        made = made.orderBy(order).limit(limit)
    return made.orderBy("source", "q")


def with_seed(questions: DataFrame, articles: DataFrame, require: bool = False, source: str = "source", path: str = "path", title: str = "title", text: str = "text") -> DataFrame:
    """Questions beside the article they were asked of, as what reading it would have returned: title, seed.

    Without the article the seed is null, or with ``require`` the question goes. An article is cut once, however many ask.
    """
    seed = F.concat(F.lit("# "), F.col(title), F.lit("\n\n"), M.truncate(text, ARTICLE_CHARS))
    return questions.join(articles.select(F.col(path).alias(source), F.col(title).alias("title"), seed.alias("seed")), source, "inner" if require else "left")


def seed_messages(title: str | Column, seed: str | Column) -> Column:
    """The call that the model did not make and its result, as messages; none without a seed."""
    kind = "array<struct<role: string, content: string, tool: string, arguments: string>>"
    message = lambda role, content, tool, arguments: F.struct(F.lit(role).alias("role"), content.alias("content"), tool.alias("tool"), arguments.alias("arguments"))
    call = message("assistant", F.lit(""), F.lit("read_article"), F.to_json(F.struct(T.col(title).alias("title"))))
    return F.when(T.col(seed).isNotNull(), F.array(call, message("tool", T.col(seed), F.lit("read_article"), F.lit(None).cast("string"))).cast(kind)).otherwise(F.array().cast(kind))


def by_split(records: DataFrame, order: str, limit: int | None = None) -> DataFrame:
    """Records with their split, train where none is named, and of each split the first ``limit``."""
    made = records.withColumn("split", F.coalesce(F.when(F.col("split") != "", F.col("split")), F.lit("train")))
    if limit is None:
        return made
    return made.withColumn("_n", F.row_number().over(Window.partitionBy("split").orderBy(order))).where(F.col("_n") <= limit).drop("_n")


def reject_rates(rows: DataFrame, reason: str = "reason") -> DataFrame:
    """(kind, n, rate): rejections by what stands before the colon, and their share of all candidates; kept rows have no reason."""
    kinds = rows.groupBy(F.split_part(F.col(reason), F.lit(":"), F.lit(1)).alias("kind")).agg(F.count("*").alias("n"))
    return kinds.withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).where("kind is not null")  # few kinds


def top_leaks(rows: DataFrame, reason: str = "reason", k: int = TOP_LEAKS) -> DataFrame:
    """The phrases that most often gave a persona away."""
    phrase = F.regexp_extract(reason, r"(?s)\Apersona leak: (.*)\z", 1)
    return rows.where(F.startswith(F.col(reason), F.lit("persona leak: "))).groupBy(phrase.alias("phrase")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "phrase").limit(k)


def _cost(sizes: DataFrame, rates: dict[str, float], thinking: bool) -> DataFrame:
    out = F.col("tokens_out") * (THINKING if thinking else 1.0)
    cost = ((F.col("tokens_in") - F.col("cached")) * rates["in"] + F.col("cached") * rates["cached"] + out * rates["out"]) / 1e6
    return sizes.withColumn("tokens_out", out).withColumn("cost", cost)


def paraphrase_estimate(articles: DataFrame, body: str, system_chars: int, chunk_chars: int = M.CHUNK_CHARS, rates: dict[str, float] = RATES, thinking: bool = False) -> DataFrame:
    """One row: articles, usable, requests, chars, tokens_in, cached, tokens_out, cost. Tables cost no request."""
    sent = F.filter(M.chunks(body, chunk_chars), lambda c: ~M.is_table(c))
    per = articles.select(M.skip_reason(body).isNull().alias("ok"), F.size(sent).alias("n"), F.aggregate(sent, F.lit(0).cast("long"), lambda a, c: a + F.char_length(c)).alias("chars"))
    whole = per.agg(F.count("*").alias("articles"), F.count_if("ok").alias("usable"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).alias("requests"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("chars"))), F.lit(0)).alias("chars"))
    whole = whole.withColumn("cached", F.col("requests") * system_chars / T.CHARS_PER_TOKEN)
    whole = whole.withColumn("tokens_in", F.col("chars") / T.CHARS_PER_TOKEN + F.col("cached") + F.col("requests") * SYSTEM_TOKENS["paraphrase"])
    return _cost(whole.withColumn("tokens_out", F.col("chars") / T.CHARS_PER_TOKEN), rates, thinking)


def question_estimate(requests: DataFrame, prompt: str, system_chars: int, rates: dict[str, float] = RATES, thinking: bool = False) -> DataFrame:
    """One row: requests, chars, wanted (questions asked for), tokens_in, cached, tokens_out, cost."""
    n = F.char_length(prompt)
    whole = requests.agg(F.count("*").alias("requests"), F.coalesce(F.sum(n), F.lit(0)).alias("chars"), F.coalesce(F.sum(T.question_count(n)), F.lit(0)).alias("wanted"))
    whole = whole.withColumn("cached", F.col("requests") * system_chars / T.CHARS_PER_TOKEN)
    whole = whole.withColumn("tokens_in", F.col("chars") / T.CHARS_PER_TOKEN + F.col("cached") + F.col("requests") * SYSTEM_TOKENS["questions"])
    return _cost(whole.withColumn("tokens_out", F.col("wanted") * float(TOKENS_PER_QUESTION)), rates, thinking)


def answer_estimate(questions: DataFrame, articles: DataFrame, system_chars: int, rates: dict[str, float] = RATES, seeded: bool = True, thinking: bool = False, source: str = "source", path: str = "path", text: str = "text") -> DataFrame:
    """One row: questions, missing (without their article), seed_chars, tokens_in, cached, tokens_out, cost. Rounds beyond the first resend everything."""
    sizes = articles.select(F.col(path).alias(source), F.least(F.octet_length(text), F.lit(ARTICLE_CHARS)).alias("_size"))
    asked = questions.join(sizes, source, "left").withColumn("_size", F.coalesce("_size", F.lit(0)))
    seed = F.sum("_size") if seeded else F.lit(0)
    whole = asked.agg(F.count("*").alias("questions"), F.count_if(F.col("_size") == 0).alias("missing"), F.coalesce(seed, F.lit(0)).cast("long").alias("seed_chars"), F.coalesce(F.sum(F.char_length("q")), F.lit(0)).alias("_q"))
    base = (F.col("questions") * system_chars + F.col("seed_chars") + F.col("_q")) / T.CHARS_PER_TOKEN
    whole = whole.withColumn("tokens_in", base + EXTRA_ROUNDS * (base + F.col("questions") * TOOL_CHARS / T.CHARS_PER_TOKEN)).withColumn("cached", F.col("questions") * system_chars / T.CHARS_PER_TOKEN)
    return _cost(whole.withColumn("tokens_out", F.col("questions") * (1 + EXTRA_ROUNDS) * ANSWER_CHARS / T.CHARS_PER_TOKEN).drop("_q"), rates, thinking)


def converted(pages: DataFrame, body: str, least: int = MIN_CONVERTED_CHARS) -> DataFrame:
    """Adds error: null, empty_after_clean for a body of too few characters, or what the converter said (a null body)."""
    said = F.col("error") if "error" in pages.columns else F.lit(None).cast("string")
    short = F.coalesce(F.char_length(T.strip(body)), F.lit(0)) < least
    return pages.withColumn("error", F.when(said.isNotNull(), said).when(short, "empty_after_clean"))


def registry(sources: DataFrame, views: DataFrame) -> DataFrame:
    """(name, license, restricted, derived_from) of the given sources and of the outputs of configured views, which derive from one."""
    columns = ["name", "license", "restricted", "derived_from"]
    return sources.select(*columns).unionByName(views.select("name", "license", F.lit(False).alias("restricted"), "derived_from"))


def select_sources(known: DataFrame, names: list[str] | None = None, restricted: bool = False) -> DataFrame:
    """Sources of these names, else all; restricted ones only if asked for. An unknown name is an error."""
    if names is not None:
        if unknown := unknown_names(names, [r.name for r in known.select("name").collect()]):  # a configured list
            raise ValueError(f"unknown sources: {', '.join(unknown)}")
        known = known.where(F.col("name").isin(*names))
    return known if restricted else known.where(~F.col("restricted"))
