"""Ordered validators: a column with the first reason against a row, or null to keep it."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from textloom.functions import markdown as M
from textloom.functions import text as T
from textloom.functions.text import col, normalize_match

# Patterns, as text.
REFUSAL = r"^\s*(?:i (?:can'?t|cannot|won'?t|am unable)|as an ai|i'm sorry)"
FORBIDDEN = (
    r"\b(?:the|this|that) (?:article|passage|excerpt|infobox|source text)\b",
    r"\baccording to the (?:article|passage|text|source)\b",
    r"\bthe (?:above|following|given) (?:text|passage|information)\b",
    r"\bas an ai\b",
)
META = (
    r"\b(?:th(?:e|is|at)|the given|the above)\s+(?:passage|article|text|excerpt|document|infobox|section|page|entry|source)\b"
    r"|\baccording to (?:the|this)\b|\bas (?:described|mentioned|stated|shown) (?:above|here|in)\b"
)
PRONOUN_OPENING = r"^(?:who|what|when|where|why|how|which)\b[^?]{0,30}?\b(?:he|she|it|they|him|her|them|his|hers|its|their|this|that)\b"
LEAKS = (
    r"\bwikipedia\b",
    r"\b(?:the|this|that|our|its)\s+(?:article|entry|excerpt|passage|corpus|database|dataset|wiki)\b(?!\s*[\"“*'])",
    r"\binfobox\b",
    r"\b(?:article|entry|passage|excerpt)s?\s+(?:says?|states?|notes?|mentions?|indicates?|reads?|describes?|lists?|do(?:es)?\s+not|don't|doesn't)\b",
    r"\b(?:the|my|our)\s+sources?\s+(?:says?|states?|notes?|mentions?|indicates?|do(?:es)?\s+not|don't)\b",
    r"\baccording to (?:the |my |our )?(?:article|entry|passage|text|source|excerpt|record|available|what)\b",
    r"\bbased on (?:the |my |what )?(?:article|entry|passage|text|search|source|information|data|I (?:found|read))\b",
    r"\bI (?:searched|looked (?:it |this )?up|could not find|couldn't find|was unable to find|have no (?:record|information|data))\b",
    r"\bmy (?:search|tools?|memory banks?|training data|knowledge base)\b",
    r"\bthe available (?:information|data|sources?)\b",
    r"\bsearch(?:ing)? (?:results?|the corpus|turned up)\b",
    r"\bas an AI\b",
    r"\bon my part\b",
    r"\blet me (?:address|answer|correct|clarify|rephrase|start over|try again)\b",
    r"^\s*sources?\s*:",
    r"\[\d+\]",
)
DECLINES = (
    r"\b(?:never (?:been )?(?:established|recorded|specified|revealed|stated|detailed|named)"
    r"|(?:was|is|has) not (?:been )?(?:established|recorded|specified|revealed|documented)"
    r"|no (?:such )?(?:detail|record|account|information) (?:was|is|has|exists)|remains? unknown|isn't (?:known|recorded)|is not known)\b"
)
PREAMBLE = (
    r"\A\s*(?:(?:okay|alright|all right|right|good|great|perfect)[,.!—-]+\s*|(?:you(?:'re| are) right|that was an accidental|apolog\w+)[^.!?\n]*[.!—]\s*"
    r"|I(?:'ve| have| now have| can confirm| see| understand)[^.!?\n]*[.!—]\s*|now I have[^.!?\n]*[.!—]\s*|let me [^.!?\n]*[.!:—]\s*)+"
)
TRAILING_SOURCES = r"(?is)\n+\s*(?:\*\*)?sources?(?:\*\*)?\s*:.*\z"
NAMES = r"\b[A-Z][A-Za-z0-9'\-]*(?:\s+(?:of|the|and|for|in|a|an|to)\s+[A-Z][A-Za-z0-9'\-]*|\s+[A-Z][A-Za-z0-9'\-]*)*"
NUMBERS = r"\b\d[\d,.]*\b"
CONNECTIVES = r"\s+(?:of|the|and|for|in|a|an|to)\s+"
ROLE_WORDS = frozenset(
    """jedi sith master padawan knight apprentice general admiral captain commander colonel lieutenant sergeant major moff grand lord
    darth king queen prince princess senator chancellor governor emperor empress doctor baron count duke viceroy warden inquisitor
    overseer marshal""".split()
)
GRAMMAR_WORDS = frozenset(
    """this that these those it its he she they his her their there here who what when where why how which while after before during
    since because but and or so yes no not both either neither however although though instead meanwhile afterward afterwards later
    then also still first second third finally notably crucially interestingly specifically importantly essentially ultimately
    eventually initially originally later once given based beyond across between within without under over into onto upon about i'm
    i've i'd i'll we we're they're it's he's she's there's that's you your rather indeed likewise besides moreover furthermore
    nonetheless regardless let by in on at to for with from as of the a an""".split()
)
LICENSED = (
    "legends legends-era legends-continuity canon canon-continuity non-canon noncanon real-world expanded universe star wars eu continuity timeline"
)
MIN_ANSWER_CHARS, MAX_ANSWER_CHARS, DECLINE_MAX_CHARS, MIN_KEPT_CHARS = 2, 4000, 240, 80
MIN_Q_CHARS, MAX_Q_CHARS, MIN_SPAN_CHARS, WINDOW = 15, 300, 20, 300
LEN_RATIO = (0.55, 2.0)
MAX_DEGRADED = 0.5


def first_reason(*checks: tuple[Column, str | Column]) -> Column:
    out = None
    for test, reason in checks:
        reason = F.lit(reason) if isinstance(reason, str) else reason
        out = F.when(test, reason) if out is None else out.when(test, reason)
    return out


@dataclass(frozen=True)
class View:
    """A rewrite described by configuration alone."""

    name: str
    out_dir: str = ""
    system: str = ""
    user_template: str = ""
    enabled: bool = True
    temperature: float = 1.0
    thinking: bool = False
    max_attempts: int = 4
    max_input_chars: int = 12000
    infobox_chars: int = 1500
    include_infobox: bool = True
    drop_tables: bool = True
    min_body_chars: int = 400
    require_pattern: str = ""
    continuity: tuple[str, ...] = ()
    min_out_chars: int = 200
    min_out_ratio: float = 0.0
    max_out_ratio: float = 1.5
    require_title: bool = True
    check_dates: bool = True
    est_out_ratio: float = 0.6
    title_suffix: str = ""
    forbid: tuple[str, ...] = FORBIDDEN


def eligible(body: str | Column, continuity: str | Column, view: View, stripped: Column | None = None) -> Column:
    """Why an article is not sent to a view."""
    return F.get(eligibility(body, continuity, (view,), stripped), 0)


def eligibility(body: str | Column, continuity: str | Column, views: Sequence[View], stripped: Column | None = None) -> Column:
    """For each view why an article is not sent to it; the article is read once for all of them."""

    def reason(m: Column, view: View) -> Column:
        checks = [(m["skip"].isNotNull(), m["skip"]), (F.char_length(m["rest"]) < view.min_body_chars, "too short for view")]
        if view.continuity:
            checks.append((~F.coalesce(m["continuity"], F.lit("")).isin(*view.continuity), "continuity excluded"))
        if view.require_pattern:
            checks.append((~m["rest"].rlike(f"(?i){view.require_pattern}"), "pattern not found"))
        return first_reason(*checks)

    def measured(a: Column) -> Column:
        rest = M.strip_tables(a["body"], a["prose"]) if stripped is None else a["stripped"]
        both = F.struct(M.skip_reason(a["body"], parts=a["prose"]).alias("skip"), rest.alias("rest"), a["continuity"].alias("continuity"))
        return T.let(both, lambda m: F.array(*[reason(m, v) for v in views]))

    given = [] if stripped is None else [stripped.alias("stripped")]
    return T.let(F.struct(col(body).alias("body"), M.prose(body).alias("prose"), col(continuity).alias("continuity"), *given), measured)


def rewrite_reason(out: str | Column, packed: str | Column, title: str | Column, view: View, finish: Column | None = None) -> Column:
    """Why a rewrite is not kept."""
    out, packed = col(out), col(packed)
    ratio = F.char_length(out) / F.greatest(F.char_length(packed), F.lit(1))
    said = F.concat(F.lit("length ratio "), T.two_decimals(ratio))
    checks = [(F.coalesce(out, F.lit("")) == "", "empty response"), (out.rlike(f"(?i){REFUSAL}"), "refusal")]
    if finish is not None:
        checks.append((finish == "length", "truncated"))
    checks.append((F.char_length(out) < view.min_out_chars, F.concat(F.lit("too short ("), F.char_length(out).cast("string"), F.lit(" chars)"))))
    if view.min_out_ratio:
        checks.append((ratio < view.min_out_ratio, said))
    if view.max_out_ratio:
        checks.append((ratio > view.max_out_ratio, said))
    if view.require_title:
        checks.append((~T.title_present(title, out), "subject missing"))
    for pattern in view.forbid:
        checks.append((out.rlike(f"(?i){pattern}"), F.concat(F.lit("meta-talk: '"), F.regexp_extract(out, f"(?i){pattern}", 0), F.lit("'"))))
    if view.check_dates:
        made_up = F.array_sort(F.array_except(T.era_dates(out), T.era_dates(packed)))
        checks.append((F.size(made_up) > 0, F.concat(F.lit("date not in source: "), F.get(made_up, 0))))
    return first_reason(*checks)


def chunk_reason(out: str | Column, source: str | Column, finish: Column | None = None) -> Column:
    """Why a reworded chunk is not accepted; only lost headings leave it usable as a last resort."""
    out, source = col(out), col(source)
    ratio = F.char_length(out) / F.greatest(F.char_length(source), F.lit(1))
    headings = lambda c: F.regexp_count(c, F.lit("(?m)^#{2,6} .*$"))
    checks = [(F.coalesce(out, F.lit("")) == "", "empty response"), (out.rlike(f"(?i){REFUSAL}"), "refusal")]
    if finish is not None:
        checks.append((finish == "length", "truncated"))
    return first_reason(*checks, ((ratio < LEN_RATIO[0]) | (ratio > LEN_RATIO[1]), "length ratio"), (headings(out) < headings(source), "headings lost"))


def degraded(chunks: DataFrame, doc: str, failed: str, chars: str, sent: str) -> DataFrame:
    """(doc, share, rejected): failed characters among those sent; over half, the article is rejected."""
    share = F.sum(F.when(F.col(failed) & F.col(sent), F.col(chars)).otherwise(0)) / F.greatest(F.sum(F.when(F.col(sent), F.col(chars)).otherwise(0)), F.lit(1))
    return chunks.groupBy(doc).agg(share.alias("share")).withColumn("rejected", F.col("share") > MAX_DEGRADED)


def strip_preamble(answer: str | Column) -> Column:
    """Without opening talk about the search, if 80 characters are left."""
    kept = F.ltrim(F.regexp_replace(col(answer), f"(?i){PREAMBLE}", ""))
    return F.when((kept != col(answer)) & (F.char_length(kept) >= MIN_KEPT_CHARS), kept).otherwise(col(answer))


def strip_citations(answer: str | Column) -> Column:
    return T.strip(F.regexp_replace(col(answer), TRAILING_SOURCES, ""))


def answer_reason(answer: str | Column, tool_calls: Column | int, allow_untooled: bool = False, leaks: tuple[str, ...] = LEAKS, sites: tuple[str, ...] = ()) -> Column:
    """Why an answer is not kept. sites: names of the corpus's own site, which an answer must not mention either."""
    leaks = (*[rf"\b{re.escape(s)}\b" for s in sites], *leaks)
    answer, calls = F.coalesce(col(answer), F.lit("")), tool_calls if isinstance(tool_calls, Column) else F.lit(tool_calls)
    leak = F.regexp_extract(answer, "(?im)" + "|".join(leaks), 0)
    return first_reason(
        (F.char_length(answer) < MIN_ANSWER_CHARS, "empty answer"), (F.char_length(answer) > MAX_ANSWER_CHARS, "answer too long"),
        ((calls == 0) & F.lit(not allow_untooled), "no tools used"), (leak != "", F.concat(F.lit("persona leak: "), F.substring(F.lower(T.strip(leak)), 1, 40))),
        ((F.char_length(answer) <= DECLINE_MAX_CHARS) & answer.rlike(f"(?i){DECLINES}"), "declined a recorded fact"),
    )


# Names and numbers: how a phrase splits depends on what was found before, so these run on Arrow batches.


def _fold(s: str) -> str:
    return " ".join(s.replace("*", "").replace("_", " ").split()).casefold()


def _occurs(name: str, text: str) -> bool:
    return name in text or (len(name) > 1 and name[-1] == "s" and name[:-1] in text)


def named_terms(text: str, title: str) -> tuple[list[str], list[str], frozenset[str]]:
    """Capitalised phrases after the first character that are more than the title's words, numbers, the title's words."""
    known = frozenset(re.findall(T.WORD, title.casefold()))
    phrases = []
    for phrase in re.findall(NAMES, text[1:]):
        # A possessive ends a name: "Drohon's Tempest" is two.
        for part in re.split(r"(?:'s|')(?:\s+|$)", phrase):
            part = part.strip().removesuffix("'")
            own = re.findall(T.WORD, part.casefold())
            if own and not known.issuperset(own):
                phrases.append(part)
    return phrases, re.findall(NUMBERS, text), known


def phrase_fault(phrase: str, near: str, whole: str, known: frozenset[str]) -> str | None:
    """Why a phrase is not supported by the text near the evidence and the whole text, both normalised."""
    name = _fold(phrase)
    if _occurs(name, near):
        return None
    if _occurs(name, whole):
        own = [w for w in re.findall(T.WORD, phrase.casefold()) if w not in ROLE_WORDS]
        return None if any(w in near for w in own) else "term not near evidence"
    words = phrase.split()
    inner = [k for k, w in enumerate(words) if w.casefold() not in known]
    trimmed = " ".join(words[inner[0] : inner[-1] + 1]) if inner else ""
    first = None
    for parts in ([p for p in map(str.strip, re.split(CONNECTIVES, phrase)) if p], [trimmed] if trimmed else []):
        if not parts or parts == [phrase]:
            continue
        faults = [f for f in (phrase_fault(p, near, whole, known) for p in parts) if f]
        if not faults:
            return None
        first = first or faults[0]
    return first or "name not in article"


@F.pandas_udf(StringType())
def _terms_fault(question: pd.Series, title: pd.Series, window: pd.Series, passage: pd.Series) -> pd.Series:
    out = []
    for q, t, near, whole in zip(question, title, window, passage):
        fault = None
        if q and near:
            phrases, numbers, known = named_terms(q, t or "")
            faults = ((f, p) for p in phrases if (f := phrase_fault(p, near, whole, known)))
            found = next(faults, None)
            fault = f"{found[0]}: {found[1]}" if found else "number not near evidence" if any(n not in near and n.replace(",", "") not in near for n in numbers) else None
        out.append(fault)
    return pd.Series(out, dtype=object)


def question_reason(question: str | Column, evidence: str | Column, title: str | Column, passage: str | Column, terms: bool = True) -> Column:
    """Why a question is not kept; ``terms`` also checks its names and numbers against the evidence."""
    q, e = col(question), F.coalesce(col(evidence), F.lit(""))
    window = T.evidence_window(e, col(passage), WINDOW, MIN_SPAN_CHARS)
    checks = [
        (~F.endswith(q, F.lit("?")), "not a question"), (~F.char_length(q).between(MIN_Q_CHARS, MAX_Q_CHARS), "length"),
        (q.rlike(f"(?i){META}") | e.rlike(f"(?i){META}"), "meta-reference"), (e == "", "no evidence"),
        (F.char_length(normalize_match(e)) < MIN_SPAN_CHARS, "evidence too short"), (window.isNull(), "evidence not in passage"),
    ]
    if terms:
        fault = _terms_fault(q, col(title), window, normalize_match(passage))
        checks.append((fault.isNotNull(), fault))
    checks.append((q.rlike(f"(?i){PRONOUN_OPENING}") & ~F.substring(q, F.lit(2), F.char_length(q)).rlike(r"\b[A-Z][A-Za-z0-9'\-]{2,}"), "pronoun subject"))
    return first_reason(*checks)


@F.pandas_udf(ArrayType(StringType()))
def unsupported_terms(answer: pd.Series, question: pd.Series, title: pd.Series, read: pd.Series) -> pd.Series:
    """Names and numbers of an answer that occur in nothing read, in order, each once; recorded, not enforced."""
    out = []
    for a, q, t, r in zip(answer, question, title, read):
        text = _fold(f"{r or ''}\n{q or ''}\n{LICENSED}")
        phrases, numbers, known = named_terms(" " + (a or ""), t or "")
        bad = []
        for phrase in phrases:
            words = phrase.split()
            inner = [k for k, w in enumerate(words) if w.casefold() not in GRAMMAR_WORDS | ROLE_WORDS]
            if inner and phrase_fault(p := " ".join(words[inner[0] : inner[-1] + 1]), text, text, known):
                bad.append(p)
        bad += [n for n in numbers if not _occurs(n, text) and not _occurs(n.replace(",", ""), text)]
        out.append(list(dict.fromkeys(bad)))
    return pd.Series(out)


# Kinds of questions.
QUESTION_TYPES = tuple("factoid numeric date definition list causal comparison multihop chronology relationship description production yesno open".split())


def parse_questions(text: str | Column, types: tuple[str, ...] = QUESTION_TYPES) -> Column:
    """array<struct<kind, question, evidence>> from lines "kind | question | evidence", forgiving fences, bullets and missing fields."""
    inner = F.regexp_replace(T.strip(text), r"(?s)\A```[a-z]*\s*\n(.*)\n```\s*\z", "$1")
    rows = F.transform(F.split(inner, "\n", -1), lambda x: T.strip(F.regexp_replace(x, r"\A\s*(?:[-*•]|\d+[.)])\s*", "")))
    plain = lambda c: T.strip(F.regexp_replace(T.strip(c), r'\A"+|"+\z', ""))

    def one(line: Column) -> Column:
        parts = F.transform(F.split(line, r"\|", 3), T.strip)
        n, head = F.size(parts), F.lower(F.get(parts, 0))
        known = head.isin(*types)
        kind = F.when((n > 1) & known, head).otherwise(F.lit("other"))
        question = F.when(n == 3, F.get(parts, 1)).when((n == 2) & known, F.get(parts, 1)).otherwise(F.get(parts, 0))
        evidence = F.when(n == 3, F.get(parts, 2)).when((n == 2) & ~known, F.get(parts, 1)).otherwise(F.lit(""))
        return F.struct(kind.alias("kind"), plain(question).alias("question"), plain(evidence).alias("evidence"))

    return F.transform(F.filter(rows, lambda x: x != ""), one)


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def best_batch(attempts: DataFrame, doc: str, attempt: str, kept: str, asked: str, least: float = 0.4) -> DataFrame:
    """Of each article the first attempt that kept enough of what it was asked for, else the one that kept most."""
    enough = F.min(F.when(F.col(kept) >= least * F.col(asked), F.col(attempt)))
    return attempts.groupBy(doc).agg(F.coalesce(enough, F.max_by(attempt, F.struct(F.col(kept), -F.col(attempt)))).alias(attempt))
