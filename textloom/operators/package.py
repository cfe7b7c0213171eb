"""Rows of the packaged datasets: training text, question and answer rows, article documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import markdown as M
from textloom.functions.text import col, strip

# What is shown for each continuity.
LABELS = {"canon": "Canon", "legends": "Legends", "non-canon": "Non-canon", "real-world": "Real-world"}


def attribution_url(title: str | Column, base: str) -> Column:
    return F.concat(F.lit(base), F.translate(col(title), " ", "_"))


def training_text(title: Column, origin: Column, continuity: Column, box: Column, body: Column) -> Column:
    """What a model is trained on: the title, where it is from and of which continuity, infobox and body."""
    label = F.get(F.filter(F.array(*[F.when(continuity == k, F.lit(v)) for k, v in LABELS.items()]), lambda x: x.isNotNull()), 0)
    part = lambda c: F.when(strip(c) != "", F.concat(F.lit("\n"), strip(c), F.lit("\n"))).otherwise(F.lit(""))
    box_ = F.when(strip(box) != "", F.concat(F.lit("\n"), F.regexp_replace(box, r"\s+\z", ""), F.lit("\n"))).otherwise(F.lit(""))
    return F.concat(F.lit("# "), title, F.lit("\n\n*"), origin, F.coalesce(F.concat(F.lit(" · "), label), F.lit("")), F.lit("*\n"), box_, part(body))


def document_rows(files: DataFrame, origin: str, license: str, base_url: str | None = None, derived: str | None = None) -> DataFrame:
    """Rows of the pretraining table from (path, text), path relative to the source; empty documents are dropped."""
    front, markdown = M.frontmatter("text"), F.lower("path").endswith(".md")
    stem = F.translate(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", ""), "_", " ")
    title = F.when(markdown, F.coalesce(M.front_scalar(front, "title"), stem)).otherwise(stem)
    box, body = F.when(markdown, M.infobox("text")).otherwise(F.lit("")), F.when(markdown, M.body("text")).otherwise(F.col("text"))
    own_url = F.when(markdown, M.front_scalar(front, "url"))
    mirrored = F.concat(F.lit(f"{derived}/"), "path") if derived else F.lit(None).cast("string")
    cat = F.when(markdown, M.front_list(front, "categories")).otherwise(F.array().cast("array<string>"))
    rows = files.select(
        F.concat(F.lit(f"{origin}/"), "path").alias("doc_id"), title.alias("title"), F.when(markdown, M.front_scalar(front, "continuity")).alias("continuity"), F.lit(origin).alias("source"),
        F.coalesce(own_url, attribution_url(title, base_url) if base_url else F.lit(None).cast("string")).alias("url"), cat.alias("categories"),
        F.coalesce(F.when(markdown, F.coalesce(M.front_scalar(front, "paraphrased_from"), M.front_scalar(front, "augmented_from"))), mirrored).alias("derived_from"),
        F.lit(license).alias("license"), box.alias("_box"), body.alias("_body"),
    ).where((strip("_box") != "") | (strip("_body") != ""))
    text = training_text(F.col("title"), F.col("source"), F.col("continuity"), F.col("_box"), F.col("_body"))
    return rows.select(text.alias("text"), "doc_id", "title", "continuity", "source", "url", "categories", "derived_from", "license")


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def sft_rows(records: DataFrame, prompt: str) -> DataFrame:
    """Answer records as three messages; lists that are missing are empty, a missing number of tools is 0."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    none = F.array().cast("array<string>")
    made = {
        "messages": F.array(message("system", F.lit(prompt)), message("user", F.col("q")), message("assistant", F.col("a"))), "type": _optional(records, "type", "string"),
        "continuity": _optional(records, "continuity", "string"), "source_article": _optional(records, "source", "string"), "read": F.coalesce(_optional(records, "read", "array<string>"), none),
        "tools": F.coalesce(_optional(records, "tools", "int"), F.lit(0)), "teacher_model": _optional(records, "model", "string"), "unsupported": F.coalesce(_optional(records, "unsupported", "array<string>"), none),
    }
    return records.withColumns(made)


def question_rows(records: DataFrame) -> DataFrame:
    return records.select("q", *[_optional(records, old, "string").alias(new) for old, new in (("type", "type"), ("continuity", "continuity"), ("source", "source_article"), ("evidence", "evidence"))])


def article_document(title: Column, continuity: Column, source: Column, categories: Column, box: Column, body: Column) -> Column:
    """A Markdown file: frontmatter with escaped quotes, infobox, body."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('\\"')), F.lit('"'))
    items = F.array_join(F.transform(categories, lambda c: F.concat(F.lit("  - "), quoted(c), F.lit("\n"))), "")
    listed = F.when(F.size(categories) > 0, F.concat(F.lit("categories:\n"), items)).otherwise(F.lit(""))
    front = F.concat(F.lit("---\ntitle: "), quoted(title), F.lit("\ncontinuity: "), continuity, F.lit("\nsource: "), source, F.lit("\n"), listed, F.lit("---\n\n"))
    return F.concat(front, F.when(box != "", F.concat(box, F.lit("\n"))).otherwise(F.lit("")), body, F.lit("\n"))


def derived_document(front: Column, keys: dict[str, Column], box: Column, body: Column, suffix: Column | None = None) -> Column:
    """A rewrite's file: the source's frontmatter with keys of provenance added and the title extended."""
    if suffix is not None:
        front = F.regexp_replace(front, r'(?m)\A((?s:.*?))^title:\s*"(.*)"\s*$', F.concat(F.lit('$1title: "$2 '), suffix, F.lit('"')))
    added = F.concat(*[F.concat(F.lit(f"{k}: "), v.cast("string"), F.lit("\n")) for k, v in keys.items()])
    return F.concat(F.regexp_replace(front, r"---\n\z", ""), added, F.lit("---\n\n"), F.when(box != "", F.concat(box, F.lit("\n"))).otherwise(F.lit("")), body, F.lit("\n"))


def file_name(title: str | Column) -> Column:
    """Shard letter and a safe name: <L>/<Title>.md."""
    safe = F.left(F.translate(F.regexp_replace(col(title), r'[<>:"/\\|?*\x00]', "_"), " ", "_"), F.lit(200))
    letter = F.upper(F.left(safe, F.lit(1)))
    return F.concat(F.when(letter.rlike(r"^[\p{L}\p{N}]"), letter).otherwise(F.lit("_")), F.lit("/"), safe, F.lit(".md"))
