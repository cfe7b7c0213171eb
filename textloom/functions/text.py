"""Scalar text functions as column expressions; all run in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values.
STOPWORDS = tuple("the a an of and or in on at to for with from by as is was were are be list star wars".split())
ERAS = ("BBY", "ABY")
WORD = "[A-Za-z0-9']+"
CHARS_PER_TOKEN = 3.6
CHARS_PER_QUESTION, MIN_QUESTIONS, MAX_QUESTIONS = 700, 2, 12
EVAL_FRACTION = 0.02


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """White space off both ends, line ends included."""
    return F.btrim(col(c), F.lit(" \t\n\v\f\r"))


def ascii_lower(c: str | Column) -> Column:
    return F.translate(col(c), _UPPER, _LOWER)


def normalize_title(c: str | Column) -> Column:
    """Underscores are blanks, lower case, runs of anything but a-z and 0-9 are one blank."""
    return F.trim(F.regexp_replace(F.lower(F.translate(col(c), "_", " ")), "[^a-z0-9]+", " "))


def normalize_match(c: str | Column) -> Column:
    """For matching quotations: no asterisks, underscores are blanks, single blanks, lower case."""
    return F.lower(strip(F.regexp_replace(F.translate(col(c), "_*", " "), r"\s+", " ")))


def squash_lower(c: str | Column) -> Column:
    return F.lower(strip(F.regexp_replace(col(c), r"\s+", " ")))


def words(c: str | Column) -> Column:
    return F.transform(F.regexp_extract_all(col(c), F.lit(WORD), F.lit(0)), F.lower)


def dedup_key(c: str | Column) -> Column:
    return F.array_join(words(c), " ")


def token_set(c: str | Column, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    return F.array_except(F.array_distinct(words(c)), F.array(*map(F.lit, stopwords)) if stopwords else F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def era_dates(c: str | Column, eras: tuple[str, ...] = ERAS) -> Column:
    """Distinct dates, a number and an era, without commas and blanks, in lower case."""
    found = F.regexp_extract_all(col(c), F.lit(rf"\d[\d,]*(?:\.\d+)?\s*(?:{'|'.join(eras)})(?![A-Za-z0-9_])"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda x: F.lower(F.regexp_replace(x, r"[,\s]", ""))))


def hash_share(c: str | Column) -> Column:
    """From 0 to below 1: the first four bytes of SHA-1."""
    return F.conv(F.substring(F.sha1(col(c).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def assign_split(path: str | Column, fraction: float = EVAL_FRACTION) -> Column:
    """eval or train, by the article's path alone."""
    return F.lit("train") if fraction <= 0 else F.when(hash_share(path) < fraction, F.lit("eval")).otherwise(F.lit("train"))


def last_at(text: Column, part: str) -> Column:
    """Characters before the last occurrence; -1 if there is none."""
    at = F.locate(part[::-1], F.reverse(text))
    return F.when(at > 0, F.char_length(text) - at - len(part) + 1).otherwise(F.lit(-1))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def cut(c: str | Column, limit: Column | int) -> Column:
    """At most ``limit`` characters, ending at a sentence or paragraph if one ends past the half."""
    given = F.struct(col(c).alias("text"), (limit if isinstance(limit, Column) else F.lit(limit)).alias("limit"))

    def ended(s: Column) -> Column:
        kept = F.when(s["stop"] > s["limit"] * 0.5, F.substring(s["head"], F.lit(1), s["stop"] + 1)).otherwise(s["head"])
        return F.regexp_replace(kept, r"\s+$", "")

    def stopped(s: Column) -> Column:
        stop = F.greatest(*[last_at(s["head"], x) for x in (". ", ".\n", "\n\n")])
        return let(F.struct(s["head"].alias("head"), s["limit"].alias("limit"), stop.alias("stop")), ended)

    def shortened(s: Column) -> Column:
        head = F.struct(F.substring(s["text"], F.lit(1), s["limit"]).alias("head"), s["limit"].alias("limit"))
        return F.when(F.char_length(s["text"]) <= s["limit"], s["text"]).when(s["limit"] <= 0, F.lit("")).otherwise(let(head, stopped))

    return let(given, shortened)


def question_count(chars: str | Column) -> Column:
    return F.greatest(F.lit(MIN_QUESTIONS), F.least(F.lit(MAX_QUESTIONS), F.floor(col(chars) / CHARS_PER_QUESTION))).cast("int")


def occurs_in(name: Column, text: Column) -> Column:
    """Containment that forgives an s at the end of the name."""
    short = F.substring(name, F.lit(1), F.char_length(name) - 1)
    return F.contains(text, name) | ((F.char_length(name) > 1) & F.endswith(name, F.lit("s")) & F.contains(text, short))


def evidence_window(span: Column, passage: Column, radius: int = 300, least: int = 20) -> Column:
    """Normalised text around the first place of the span; null if it is short or not there."""
    span, passage = normalize_match(span), normalize_match(passage)
    at = F.instr(passage, span)
    first = F.greatest(F.lit(1), at - radius)
    window = F.substring(passage, first, at + F.char_length(span) + radius - first)
    return F.when((F.char_length(span) >= least) & (at > 0), window)


def title_present(title: str | Column, out: str | Column) -> Column:
    """Whether a rewrite names its subject: the title without a closing parenthesis, or most of its long words."""
    base, body = strip(F.regexp_replace(col(title), r"\s*\([^)]*\)\s*$", "")), squash_lower(out)
    long = F.filter(F.regexp_extract_all(base, F.lit(WORD), F.lit(0)), lambda w: F.char_length(w) > 3)
    hits = F.size(F.filter(long, lambda w: F.contains(body, F.lower(w))))
    whole = squash_lower(base)
    return ((whole != "") & F.contains(body, whole)) | (F.size(long) == 0) | (hits >= 0.6 * F.size(long))


def two_decimals(x: Column) -> Column:
    """A double from 0 on with two decimals, rounded as its exact binary value is: 8.425 lies above the tie, 2.675 below, 1.125 on it.

    The product with 100 has a rounding error, which is computed exactly by splitting the number in two halves.
    """
    p = x * 100.0
    high = x * 134217729.0 - (x * 134217729.0 - x)
    error = (high * 100.0 - p) + (x - high) * 100.0
    n = F.floor(p).cast("long")
    rest = p - n
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (n % 2 == 1))))
    made = n + up.cast("long")
    return F.concat(F.floor(made / 100).cast("string"), F.lit("."), F.lpad((made % 100).cast("string"), 2, "0"))


def human(n: float) -> str:
    """Bytes for people."""
    for unit in ("B", "kB", "MB", "GB"):
        if abs(n) < 1000:
            return f"{n:.0f} {unit}" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1000
    return f"{n:.1f} TB"


def compact(n: float) -> str:
    """Counts for people."""
    for size, unit in ((1e9, "B"), (1e6, "M"), (1e3, "K")):
        if abs(n) >= size:
            return f"{n / size:.1f}{unit}"
    return f"{n:.0f}"
