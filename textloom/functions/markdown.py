"""Structure of Markdown articles as column expressions: parts, headings, tables, chunks, cleaning."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.functions.text import col, cut, let, strip

# Fixed values.
TABLE_LINE = r"[^\S\n]*(?:\||</?(?:table|thead|tbody|tfoot|tr|th|td|caption)\b)"
BOILERPLATE = (
    "appearances", "non-canon appearances", "sources", "non-canon sources", "appearances and sources", "notes and references",
    "references", "external links", "see also", "gallery", "alternate choices", "trivia",
)
CHUNK_CHARS = 6000
MIN_BODY_CHARS = 120
INDEX_MIN_ITEMS, INDEX_LINE_FRACTION = 20, 0.5
CONTEXT_CHARS = 400
_FRONT = r"\A(---\n(?s:.*?)\n---\n)"
_BOX = r"\A(## Infobox\n(?:-[^\n]*\n|[ \t]+[^\n]*\n|[ \t]*\n)*)"


def lines(c: str | Column) -> Column:
    return F.split(col(c), "\n", -1)


def solid_lines(c: str | Column) -> Column:
    return F.filter(lines(c), lambda x: x.rlike(r"\S"))


def frontmatter(text: str | Column) -> Column:
    return F.regexp_extract(col(text), _FRONT, 1)


def _after_front(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, _FRONT, ""), r"\A\n+", "")


def infobox(text: str | Column) -> Column:
    """The heading and the bullets, indented and blank lines under it; a paragraph ends it."""
    box = F.regexp_extract(_after_front(col(text)), _BOX, 1)
    return F.when(box != "", F.concat(F.regexp_replace(box, r"\s+\z", ""), F.lit("\n"))).otherwise(F.lit(""))


def body(text: str | Column) -> Column:
    return strip_empty_sections(strip(F.regexp_replace(_after_front(col(text)), _BOX, "")))


def front_scalar(front: str | Column, key: str) -> Column:
    """One quote is taken off each side; an empty value is null."""
    value = F.regexp_extract(col(front), rf'(?m)^{key}:[ \t]*"?(.*?)"?[ \t]*$', 1)
    return F.when(value != "", value)


def front_list(front: str | Column, key: str) -> Column:
    block = F.regexp_extract(col(front), rf"(?m)^{key}:[ \t]*\n((?:[ \t]+-[^\n]*\n)*)", 1)
    return F.regexp_extract_all(block, F.lit(r'(?m)^[ \t]+-[ \t]*"?(.*?)"?[ \t]*$'), F.lit(1))


def strip_empty_sections(c: str | Column) -> Column:
    """Headings without content go, and then those left without content by that.

    Deep levels first: what follows a heading then already stays, so one pass for each level is enough.
    """
    text = col(c)
    for level in range(6, 1, -1):
        text = F.regexp_replace(text, rf"(?m)^#{{{level}}} [^\n]*(?:\n[^\S\n]*)*(?:\z|\n?(?=^#{{2,{level}}} ))", "")
    return strip(text)


def segments(c: str | Column) -> Column:
    """Runs of table lines and of other text, in turn; blank lines between tables keep them together."""
    text = col(c)
    marked = F.regexp_replace(text, rf"(?mi)^(?={TABLE_LINE})", "\u0001")
    run = r"(\u0001[^\n]*(?:\n(?:[^\S\n]*\n)*\u0001[^\n]*)*)"
    parts = F.transform(F.split(F.regexp_replace(marked, run, "\u0002$1\u0002"), "\u0002", -1), lambda x: F.translate(x, "\u0001", ""))
    parts = F.when(text.rlike(rf"(?mi)^{TABLE_LINE}"), parts).when(text.isNotNull(), F.array(text))  # most articles have no table
    return F.filter(F.transform(parts, lambda x: F.btrim(x, F.lit("\n"))), lambda x: x != "")


def is_table(c: str | Column) -> Column:
    """Whether there is a line that is not blank and all such lines are a table's; the search ends at the first other one."""
    return col(c).rlike(r"\S") & ~col(c).rlike(rf"(?dmi)^(?!{TABLE_LINE})[^\S\n]*\S")


def prose(c: str | Column) -> Column:
    """The segments that are no tables."""
    return F.filter(segments(c), lambda s: ~is_table(s))


def prose_chars(c: str | Column) -> Column:
    return _chars(prose(c))


def _chars(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda n, s: n + F.char_length(s))


def table_chars(c: str | Column) -> Column:
    """Characters of tables, which are kept as they are."""
    return _chars(F.filter(segments(c), is_table))


def strip_tables(c: str | Column, parts: Column | None = None) -> Column:
    """``parts``: the text's ``prose``, where it is at hand."""
    kept = F.transform(prose(c) if parts is None else parts, strip)
    return F.array_join(F.filter(kept, lambda s: s != ""), "\n\n")


def is_index_list(c: str | Column, least: int = INDEX_MIN_ITEMS, share: float = INDEX_LINE_FRACTION) -> Column:
    counted = F.struct(F.size(solid_lines(c)).alias("solid"), F.size(F.filter(lines(c), lambda x: x.rlike(r"\A\s*- "))).alias("items"))
    return let(counted, lambda n: (n["items"] >= least) & (n["items"] > share * n["solid"]))


def skip_reason(c: str | Column, least: int = MIN_BODY_CHARS, index_items: int = INDEX_MIN_ITEMS, parts: Column | None = None) -> Column:
    """Why an article is not sent; null to send it. ``parts``: its ``prose``, where it is at hand."""
    text = col(c)
    return (
        F.when(F.char_length(text) < least, F.lit("too short")).when(is_index_list(text, index_items), F.lit("index list"))
        .when((prose_chars(text) if parts is None else _chars(parts)) < least, F.lit("table only"))
    )


def pack_paragraphs(section: Column, limit: int) -> Column:
    """Paragraphs in order into chunks: a new one when the next paragraph does not fit; each counts two more characters."""
    paragraphs = F.split(section, "\n\n", -1)
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"), F.lit(0).alias("size"))

    def step(s: Column, p: Column) -> Column:
        full = s["open"].isNotNull() & (s["size"] + F.char_length(p) > limit)
        return F.struct(
            F.when(full, F.concat(s["done"], F.array(s["open"]))).otherwise(s["done"]).alias("done"),
            F.when(full | s["open"].isNull(), p).otherwise(F.concat(s["open"], F.lit("\n\n"), p)).alias("open"),
            (F.when(full, F.lit(0)).otherwise(s["size"]) + F.char_length(p) + 2).alias("size"),
        )

    return F.aggregate(paragraphs, start, step, lambda s: F.concat(s["done"], F.array(s["open"])))


def chunks(c: str | Column, limit: int = CHUNK_CHARS) -> Column:
    """Tables whole; prose that fits whole; else by second-level section, and long sections by paragraph."""
    solid = lambda x: x.rlike(r"\S")

    def section(s: Column) -> Column:
        return F.when(F.char_length(s) <= limit, F.array(s)).otherwise(pack_paragraphs(s, limit))

    def piece(s: Column) -> Column:
        parts = F.flatten(F.transform(F.split(s, r"\n(?=## )", -1), section))
        return F.when(is_table(s) | (F.char_length(s) <= limit), F.array(s)).otherwise(parts)

    text, found = col(c), segments(c)
    several = (F.size(found) > 1) | is_table(text)
    return F.filter(F.when(several, F.flatten(F.transform(found, piece))).otherwise(piece(text)), solid)


def chunk_context(previous: Column, chunk: Column, limit: int = CONTEXT_CHARS) -> Column:
    """The last sentences of the chunk before, up to so many characters and at least one; none at a heading or after a table."""
    prose = strip(F.array_join(F.filter(lines(strip(previous)), lambda x: ~x.rlike(r"\A\s*#")), "\n"))
    sentences = F.reverse(F.filter(F.split(prose, r"(?<=[.!?])\s+", -1), lambda s: s != ""))
    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("over"))

    def step(s: Column, x: Column) -> Column:
        over = s["over"] | ((s["text"] != "") & (F.char_length(s["text"]) + F.char_length(x) + 1 > limit))
        return F.struct(F.when(over, s["text"]).otherwise(strip(F.concat_ws(" ", x, s["text"]))).alias("text"), over.alias("over"))

    tail = F.aggregate(sentences, start, step, lambda s: F.right(s["text"], F.lit(limit)))
    return F.when(previous.isNull() | chunk.rlike(r"\A\s*#") | is_table(previous), F.lit("")).otherwise(tail)


def condense(c: str | Column, limit: int | Column) -> Column:
    """Fit a long article into a limit: the lead, then an equal share for the opening of each section."""
    text, limit = col(c), limit if isinstance(limit, Column) else F.lit(limit)

    def opening(s: Column, share: Column) -> Column:
        def shown(x: Column) -> Column:
            tail = cut(strip(F.substring(x["s"], F.char_length(x["head"]) + 2, F.char_length(x["s"]))), x["share"] - F.char_length(x["head"]) - 2)
            return let(F.struct(x["head"].alias("head"), tail.alias("tail")), lambda y: F.when(y["tail"] != "", F.concat(y["head"], F.lit("\n\n"), y["tail"])).otherwise(y["head"]))

        return let(F.struct(s.alias("s"), F.substring_index(s, "\n", 1).alias("head"), share.alias("share")), shown)

    def joined(s: Column) -> Column:
        share = F.floor((s["limit"] - F.char_length(s["lead"])) / F.greatest(F.size(s["rest"]), F.lit(1))).cast("int")
        parts = let(F.struct(s["rest"].alias("rest"), share.alias("share")), lambda x: F.transform(x["rest"], lambda y: opening(y, x["share"])))
        return cut(F.array_join(F.filter(F.concat(F.array(s["lead"]), parts), lambda y: y != ""), "\n\n"), s["limit"])

    def split(s: Column) -> Column:
        first = strip(F.get(s["parts"], 0))
        led = ~F.startswith(F.get(s["parts"], 0), F.lit("## ")) & (first != "")
        lead = F.when(led, cut(first, F.greatest(F.floor(s["limit"] * 0.4).cast("int"), F.lit(600)))).otherwise(F.lit(""))
        rest = F.when(led, F.slice(s["parts"], F.lit(2), F.greatest(F.size(s["parts"]) - 1, F.lit(0)))).otherwise(s["parts"])
        rest = F.filter(F.transform(rest, strip), lambda x: x != "")
        return let(F.struct(lead.alias("lead"), rest.alias("rest"), s["limit"].alias("limit")), joined)

    return F.when(F.char_length(text) <= limit, text).otherwise(let(F.struct(F.split(text, r"\n(?=## )", -1).alias("parts"), limit.alias("limit")), split))


def pack_input(box: str | Column, text: str | Column, limit: int = 12000, box_limit: int = 1500, drop_tables: bool = True) -> Column:
    """What one request carries: the infobox, cut, then the body in what is left, 500 characters at least."""
    head = F.when(strip(box) != "", cut(strip(box), box_limit)).otherwise(F.lit(""))
    rest = condense(strip_tables(text) if drop_tables else text, F.greatest(limit - F.char_length(head), F.lit(500)))
    return F.array_join(F.filter(F.array(head, rest), lambda s: s != ""), "\n\n")


def clean_noise(c: str | Column) -> Column:
    """Leftover HTML out of Markdown, in this order: figures, images, categories, links, emphasis, breaks, references, blank runs."""
    text = col(c)
    # Patterns and what takes their place, in order.
    for pattern, to in (
        (r"(?is)<figure\b[^>]*>.*?</figure>", ""), (r"(?is)<figcaption\b[^>]*>.*?</figcaption>", ""), (r"(?i)<img\b[^>]*/?>", ""), (r"!\[[^\]]*\]\([^)]*\)", ""),
        (r'(?i)<a\b[^>]*href="Category:[^"]*"[^>]*>[^<]*</a>', ""), (r'(?s)<a\b[^>]*\bclass="wikilink"[^>]*>(.*?)</a>', "$1"),
        (r"(?is)<em\b[^>]*>(.*?)</em>", "*$1*"), (r"(?is)<strong\b[^>]*>(.*?)</strong>", "**$1**"), (r"(?is)<small\b[^>]*>(.*?)</small>", "$1"),
        (r"(?is)<sup\b[^>]*>(.*?)</sup>", "$1"), (r"(?is)<sub\b[^>]*>(.*?)</sub>", "$1"), (r"(?i)<br\s*/?>", "\n"), (r"\\\$", r"\$"),
    ):
        text = F.regexp_replace(text, pattern, to)
    text = unescape(text)
    return F.regexp_replace(F.regexp_replace(text, r"(?m)^[-*]\s*$\n?", ""), r"\n{3,}", "\n\n")


@F.pandas_udf(StringType())
def unescape(text: pd.Series) -> pd.Series:
    """All character references of HTML, named and by number. The table of names is Python's own, so this runs on Arrow batches."""
    return text.map(lambda t: html.unescape(t) if t and "&" in t else t)


def strip_boilerplate(c: str | Column, names: tuple[str, ...] = BOILERPLATE) -> Column:
    """Named sections go, up to the next heading of the same or a higher level.

    A named heading inside what is being dropped sets the level anew, as a section of its own.
    """
    start = F.struct(F.lit(None).cast("int").alias("skip"), F.array().cast("array<string>").alias("kept"))
    heading = r"\A(#+)\s+(.+?)\s*\z"

    def step(s: Column, line: Column) -> Column:
        level = F.char_length(F.regexp_extract(line, heading, 1))
        named = (level > 0) & F.lower(strip(F.regexp_extract(line, heading, 2))).isin(*names)
        skip = F.when(named, level).when((level > 0) & (level <= s["skip"]), F.lit(None).cast("int")).otherwise(s["skip"])
        return F.struct(skip.alias("skip"), F.when(skip.isNull(), F.concat(s["kept"], F.array(line))).otherwise(s["kept"]).alias("kept"))

    kept = F.aggregate(lines(c), start, step, lambda s: F.array_join(s["kept"], "\n"))
    return F.concat(strip(F.regexp_replace(kept, r"\n{3,}", "\n\n")), F.lit("\n"))


def categories(wikitext: str | Column) -> Column:
    """Names of category links in order, each once, without sort keys."""
    found = F.regexp_extract_all(col(wikitext), F.lit(r"(?i)\[\[Category:([^\]|]+)(?:\|[^\]]*)?\]\]"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, strip), lambda x: x != ""))


def section_names(c: str | Column) -> Column:
    return F.regexp_extract_all(col(c), F.lit(r"(?m)^## (.+)$"), F.lit(1))


def extract_section(c: str | Column, name: str | Column) -> Column:
    """From the first heading of this name to the next of the same or a higher level; null if there is none."""
    from textloom.functions.text import normalize_title

    want = normalize_title(F.lit(name) if isinstance(name, str) else name)
    start = F.struct(F.lit(0).alias("level"), F.lit(False).alias("over"), F.array().cast("array<string>").alias("kept"))

    def step(s: Column, line: Column) -> Column:
        level = F.char_length(F.regexp_extract(line, r"\A(#{2,})\s*(.+)\z", 1))
        begins = ~s["over"] & (s["level"] == 0) & (level > 0) & (normalize_title(F.regexp_extract(line, r"\A(#{2,})\s*(.+)\z", 2)) == want)
        ends = (s["level"] > 0) & (level > 0) & (level <= s["level"])
        inside = begins | ((s["level"] > 0) & ~ends & ~s["over"])
        return F.struct(
            F.when(begins, level).otherwise(s["level"]).alias("level"), (s["over"] | ends).alias("over"),
            F.when(inside, F.concat(s["kept"], F.array(line))).otherwise(s["kept"]).alias("kept"),
        )

    kept = F.aggregate(lines(c), start, step, lambda s: s["kept"])
    return F.when(F.size(kept) > 0, strip(F.array_join(kept, "\n")))


def truncate(c: str | Column, limit: int) -> Column:
    """Over the limit: the start, a note of the sizes, and the names of the sections."""
    text, names = col(c), F.array_join(section_names(c), ", ")
    note = F.concat(
        F.lit(f"\n\n[truncated at {limit} of "), F.char_length(text).cast("string"), F.lit(" characters. Sections you can recall: "), F.when(names != "", names).otherwise(F.lit("(none)")),
        F.lit(". Call read_article again with `section` to read one of them in full.]"),
    )
    return F.when(F.char_length(text) <= limit, text).otherwise(F.concat(F.substring(text, 1, limit), note))


# What a model puts around an answer.
FENCE = r"(?s)\A\s*```(?:markdown|md)?\s*\n(.*)\n```\s*\z"
ANNOUNCEMENT = r"(?i)\A\s*(?:here(?:'s| is)|sure[,!]?|certainly[,!]?)[^\n]*(?:paraphras|rewrit|reword)[^\n]*\n+"


def clean_response(c: str | Column) -> Column:
    """A model's text without the fence around it and the line that announces it."""
    text = strip(c)
    inner = F.when(text.rlike(FENCE), strip(F.regexp_extract(text, FENCE, 1))).otherwise(text)
    return strip(F.regexp_replace(inner, ANNOUNCEMENT, ""))


def restore_heading(source: Column, out: Column) -> Column:
    """Puts back the heading that a chunk opened on: instead of a reworded one of its level, else before."""
    head, first = strip(F.substring_index(F.ltrim(source), "\n", 1)), strip(F.substring_index(F.regexp_replace(out, r"\A\s+", ""), "\n", 1))
    marks = lambda x: F.regexp_extract(x, r"\A(#{2,6}) ", 1)
    body_ = F.regexp_replace(out, r"\A\s*[^\n]*(\n|\z)", "")
    reworded = F.when(body_ != "", F.concat(head, F.lit("\n"), body_)).otherwise(head)
    return F.when((marks(head) == "") | (first == head), out).when(marks(first) == marks(head), reworded).otherwise(F.concat(head, F.lit("\n\n"), out))


#: Characters from which an article is also asked about as a whole; of each section, and of the infobox.
SKELETON_MIN_CHARS, SKELETON_SECTION_CHARS, BOX_CHARS = 20_000, 260, 2000


def plan_chunks(box: str | Column, text: str | Column, limit: int = CHUNK_CHARS, box_limit: int = BOX_CHARS) -> Column:
    """Passages to ask about; the infobox, cut, goes with the first."""
    found, head = chunks(text, limit), F.regexp_replace(F.left(col(box), F.lit(box_limit)), r"\s+\z", "")
    led = F.concat(F.array(F.concat(head, F.lit("\n\n"), F.get(found, 0))), F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0))))
    return F.when((F.size(found) > 0) & (col(box) != ""), led).otherwise(found)


def skeleton(box: str | Column, text: str | Column, least: int = SKELETON_MIN_CHARS, limit: int = CHUNK_CHARS, part: int = SKELETON_SECTION_CHARS) -> Column:
    """Of a long article its lead and each heading with its opening; null for others."""
    ends = lambda c: F.regexp_replace(c, r"\s+\z", "")

    def opening(s: Column) -> Column:
        head = F.substring_index(s, "\n", 1)
        rest = ends(F.left(strip(F.substring(s, F.char_length(head) + 2, F.char_length(s))), F.lit(part)))
        return F.when(~F.startswith(head, F.lit("## ")), ends(F.left(s, F.lit(3 * part)))).when(rest != "", F.concat(head, F.lit("\n\n"), rest)).otherwise(head)

    sections = F.filter(F.transform(F.split(col(text), r"\n(?=## )", -1), strip), lambda s: s != "")
    whole = F.array_join(F.filter(F.concat(F.array(ends(F.left(col(box), F.lit(BOX_CHARS)))), F.transform(sections, opening)), lambda s: s != ""), "\n\n")
    return F.when((F.char_length(text) >= least) & (F.char_length(whole) > 20), F.left(whole, F.lit(limit)))
