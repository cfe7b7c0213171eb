"""Ranked full-text and title search; articles are rows, so there is no index to build or to merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions.markdown import extract_section, truncate
from textloom.functions.text import ascii_lower, col, normalize_title, strip

TOKEN_BONUS = 30
SNIPPET_CHARS, NEAR_NAMES, ARTICLE_CHARS = 400, 8, 14_000


def match_count(text: str | Column, needle: str, regex: bool = False) -> Column:
    """Matches that do not overlap; case is ignored for ASCII letters only. An empty literal matches nothing.

    A pattern is anchored at each article, not at the whole corpus.
    """
    text = col(text)
    if regex:
        return F.regexp_count(text, F.lit(f"(?i){needle}")).cast("long")
    if not needle:
        return F.lit(0).cast("long")
    folded, sought = _folded(text, needle)
    return F.floor((F.octet_length(folded) - F.octet_length(F.replace(folded, F.lit(sought), F.lit("")))) / len(sought.encode())).cast("long")


def _folded(text: Column, needle: str) -> tuple[Column, str]:
    """Text and needle in which capital ASCII letters are small.

    Small letters of all scripts are the faster function. For an ASCII needle it finds the same, once the two
    other characters whose small letters are ASCII are out of the way.
    """
    if not needle.isascii():
        return ascii_lower(text), "".join(c.lower() if c.isascii() else c for c in needle)
    return F.lower(F.replace(F.replace(text, F.lit("\u212a"), F.lit("\u0001")), F.lit("\u0130"), F.lit("\u0001"))), needle.lower()


def has_match(text: str | Column, needle: str, regex: bool = False) -> Column:
    if regex:
        return col(text).rlike(f"(?i){needle}")
    folded, sought = _folded(col(text), needle)
    return F.contains(folded, F.lit(sought)) & F.lit(bool(needle))


def first_hit(text: str | Column, needle: str, regex: bool = False, limit: int = SNIPPET_CHARS) -> Column:
    """The first line with a match, trimmed and cut; a fixed note if lines cannot tell."""
    hit = (lambda x: x.rlike(f"(?i){needle}")) if regex else (lambda x: F.contains(F.lower(x), F.lit(needle.lower())))
    line = strip(F.get(F.filter(F.split(col(text), "\n", -1), hit), 0))
    cut = F.when(F.char_length(line) > limit, F.concat(F.substring(line, 1, limit), F.lit("..."))).otherwise(line)
    return F.coalesce(cut, F.lit("(matched, but the line could not be isolated)"))


def count_matches(docs: DataFrame, needle: str, text: str = "text", regex: bool = False, cap: int | None = None) -> DataFrame:
    """Rows with a match and their number ``hits``; with a cap also ``capped``: over so many matches in all.

    The cap is a flag on the exact total, never a limit of the work.
    """
    # The filter is another expression than the count, so that the count is not computed twice.
    found = docs.where(has_match(text, needle, regex)).withColumn("hits", match_count(text, needle, regex))
    if regex:
        found = found.where("hits > 0")
    return found if cap is None else found.withColumn("capped", F.sum("hits").over(Window.partitionBy(F.lit(0))) > cap)


def search_text(docs: DataFrame, query: str, key: str | Column, ties: str, text: str = "text", limit: int = 8, regex: bool = False) -> DataFrame:
    """Articles by matches, 30 more for each token of the query in the key; then short keys first. With a snippet."""
    if not query.strip():
        return docs.limit(0).select(ties, F.lit("").alias("key"), F.lit(0).cast("long").alias("hits"), F.lit(0).cast("long").alias("score"), F.lit("").alias("snippet"))
    tokens = [t for t in "".join(c if c.isascii() and c.isalnum() else " " for c in query.lower().replace("_", " ")).split()]
    name = normalize_title(key)
    bonus = sum(((F.when(F.contains(F.col("key"), F.lit(t)), TOKEN_BONUS).otherwise(0)) for t in tokens), F.lit(0))
    counted = docs.where(has_match(text, query, regex)).select(ties, name.alias("key"), text, match_count(text, query, regex).alias("hits"))
    top = counted.withColumn("score", (F.col("hits") + bonus).cast("long")).orderBy(F.desc("score"), F.char_length("key"), "key", ties).limit(limit)
    return top.select(ties, "key", "hits", "score", first_hit(text, query, regex).alias("snippet"))


def search_titles(titles: DataFrame, query: str, title: str, ties: str, limit: int = 20) -> DataFrame:
    """Titles by how tightly they match: the same 100, a prefix and a blank 80, inside 60, all of several words somewhere 40."""
    q = " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in query.lower().replace("_", " ")).split())
    named = titles.select(ties, F.col(title), normalize_title(title).alias("key"))
    if not q:
        return named.limit(0).withColumn("score", F.lit(0))
    tokens = sorted(set(q.split()), key=len, reverse=True)
    score = F.when(F.col("key") == q, 100).when(F.startswith("key", F.lit(q + " ")), 80).when(F.contains("key", F.lit(q)), 60)
    if len(q.split()) > 1:
        everywhere = F.contains(F.col("key"), F.lit(tokens[0]))
        for t in tokens[1:]:
            everywhere &= F.contains(F.col("key"), F.lit(t))
        score = score.when(everywhere, 40)
    return named.withColumn("score", score).where("score is not null").orderBy(F.desc("score"), F.char_length("key"), ties).limit(limit)


def first_by_key(titles: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """One row for each key: the first in this order."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    return titles.withColumn("key", key).withColumn("_n", rank).where("_n = 1").drop("_n")


def resolve_titles(wanted: DataFrame, titles: DataFrame, wanted_title: str, title: str, order: list[str]) -> DataFrame:
    """Each wanted title beside the first article of its normalised name; null where there is none."""
    first = first_by_key(titles, normalize_title(title), order)
    return wanted.withColumn("key", normalize_title(wanted_title)).join(first, "key", "left")


def read_article(articles: DataFrame, name: str, title: str, text: str, ties: str, section: str | None = None, limit: int = ARTICLE_CHARS) -> DataFrame:
    """The article of this name, or of the names nearest to it: kind (article, section, no section, near), title, text."""
    exact = first_by_key(articles, normalize_title(title), [ties]).where(F.col("key") == normalize_title(F.lit(name)))
    if section is None:
        found = exact.select(F.lit("article").alias("kind"), F.col(title).alias("title"), truncate(text, limit).alias("text"))
    else:
        part = extract_section(text, section)
        found = exact.select(F.when(part.isNull(), "no section").otherwise("section").alias("kind"), F.col(title).alias("title"), truncate(part, limit).alias("text"))
    near = search_titles(articles, name, title, ties, NEAR_NAMES).select(F.lit("near").alias("kind"), F.col(title).alias("title"), F.lit(None).cast("string").alias("text"))
    none = exact.groupBy().count().where("count = 0")
    return found.unionByName(near.join(F.broadcast(none), how="left_semi", on=F.lit(True)))


# Index ------------------------------------------------------------------------------------------


def fingerprint_of(docs: DataFrame, ties: str, text: str = "text") -> str:
    """Changes when a row does: an index with another stamp is stale."""
    row = docs.agg(F.count("*").alias("n"), F.sum(F.xxhash64(ties, text).cast("decimal(38,0)")).alias("s")).first()
    return f"{row.n}-{row.s}"


def build_index(docs: DataFrame, path: str, ties: str, key: str | Column, text: str = "text", rebuild: bool = False) -> DataFrame:
    """(ties, key, text, folded): the folded text is written once and read again while the stamp fits."""
    spark, stamp = docs.sparkSession, fingerprint_of(docs, ties, text)
    try:
        fresh = not rebuild and spark.read.text(f"{path}/stamp").first()[0] == stamp
    except Exception:
        fresh = False
    if not fresh:
        docs.select(ties, normalize_title(key).alias("key"), text, ascii_lower(text).alias("folded")).write.mode("overwrite").parquet(f"{path}/index")
        spark.createDataFrame([(stamp,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/stamp")  # last
    return spark.read.parquet(f"{path}/index")
