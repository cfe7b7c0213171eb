"""Joins, duplicate removal, samples and reports over article, question, answer and ledger tables."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T

# Fixed values.
PRECEDENCE = ("canon", "legends", "non-canon")
DEFAULT_CONTINUITY = "real-world"
FATAL = r"^http (?:401|402|403|404)\b"
NEAR_DUPLICATE = 0.6
SAMPLES_PER_REASON = 40
RATES = {"in": 0.14, "out": 0.28, "cached": 0.0028}


# Joins ------------------------------------------------------------------------------------------


def classify(titles: DataFrame, members: DataFrame, title: str = "title", tag: str = "tag", order: tuple[str, ...] = PRECEDENCE, default: str = DEFAULT_CONTINUITY) -> DataFrame:
    """Adds continuity: of the lists that hold the title the one that comes first, else the default."""
    rank = reduce(lambda c, k: c.when(F.col(tag) == order[k], k), range(1, len(order)), F.when(F.col(tag) == order[0], 0))
    best = members.groupBy(title).agg(F.min(rank).alias("_rank")).where("_rank is not null")
    named = F.coalesce(F.get(F.array(*map(F.lit, order)), F.col("_rank")), F.lit(default))
    return titles.join(best, title, "left").withColumn("continuity", named).drop("_rank")


def outstanding(inputs: DataFrame, done: DataFrame, key: str | list[str], failures: DataFrame | None = None, retry: bool = False) -> DataFrame:
    """Inputs without an output and, unless they are to be tried again, without a real failure."""
    left = inputs.join(done, key, "left_anti")
    return left if failures is None or retry else left.join(failures, key, "left_anti")


def work_list(articles: DataFrame, views: DataFrame, done: DataFrame, article: str = "doc_id", view: str = "view") -> DataFrame:
    """Articles times views that have no output yet. Views are configured rows: more than a thousand are an error."""
    if views.limit(1001).count() > 1000:
        raise ValueError("more than a thousand views")
    return articles.join(F.broadcast(views), how="inner", on=F.lit(True)).join(done, [article, view], "left_anti")


def real_failures(ledger: DataFrame, error: str = "error") -> DataFrame:
    """Without faults of the account, which say nothing about the item."""
    return ledger.where(~F.col(error).rlike(FATAL))


def derived_from(docs: DataFrame, explicit: str, source: str, mirrored: str, path: str) -> DataFrame:
    """Adds derived_from: the key as written, else the mirrored path of a source that is itself derived."""
    made = F.when(F.col(mirrored).isNotNull(), F.concat_ws("/", mirrored, path))
    return docs.withColumn("derived_from", F.coalesce(F.when(F.col(explicit) != "", F.col(explicit)), made))


def answered(questions: DataFrame, answers: DataFrame, q: str = "q") -> DataFrame:
    """Questions and whether one of the answers has their key."""
    keys = answers.select(T.dedup_key(q).alias("_key")).distinct().withColumn("answered", F.lit(True))
    return questions.withColumn("_key", T.dedup_key(q)).join(keys, "_key", "left").withColumn("answered", F.coalesce("answered", F.lit(False))).drop("_key")


#: Spans up to which their hashes are sent to all executors; beyond, runs of words are shuffled to them.
FEW_SPANS = 200_000


def evidence_pairs(items: DataFrame, passages: DataFrame, item: str, span: str, passage: str, words: int = 6, key: str | None = None) -> DataFrame:
    """Items whose span occurs in a passage, character for character: (item, passage key), as a join on containment gives.

    Words at the ends of a span may be parts of longer ones in the passage, so a span is found by its inner
    words: by the hash of the first ``words`` of them, of all if they are fewer, among the same runs of the
    passages. Containment is then tested. Spans without an inner word (two words at most, blank ones too)
    are tested against all passages. Null and repeated keys and items are rows like others; a null span or
    passage has no pair.
    """
    key = key or passages.columns[0]
    runs = lambda c: F.filter(F.split(c, r"\s+", -1), lambda w: w != "")
    spans = items.where(F.col(span).isNotNull()).select(F.col(item).alias("_item"), F.col(span).alias("_span"), F.xxhash64(span).alias("_s"))
    texts = passages.where(F.col(passage).isNotNull()).select(F.col(key).alias("_key"), F.col(passage).alias("_text"), F.xxhash64(key, passage).alias("_t"))
    # Each word is hashed once; a run's hash is that of its words' hashes.
    words_of = lambda c: F.transform(runs(c), lambda w: F.xxhash64(w))
    run = lambda h, i, n: F.xxhash64(*[F.get(h, i + k) for k in range(n)])
    known = spans.select("_s", "_span").dropDuplicates(["_s"]).withColumn("_w", words_of(F.col("_span"))).withColumn("_n", F.least(F.lit(words), F.size("_w") - 2))
    by_length = F.coalesce(*[F.when(F.col("_n") == n, run("_w", F.lit(1), n)) for n in range(1, words + 1)])
    hashed = known.where("_n > 0").select("_s", by_length.alias("_h"), "_n")
    counts = {r["_n"]: r["count"] for r in hashed.groupBy("_n").count().collect()}  # one row for each length
    w, none = F.col("_w"), F.array().cast("array<long>")
    placed = lambda n: F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: run(w, i, n))).otherwise(none)
    places = F.concat(none, *map(placed, sorted(counts)))
    found = texts.select("_t", words_of(F.col("_text")).alias("_w")).select("_t", F.explode(F.array_distinct(places)).alias("_h"))
    small = sum(counts.values()) <= FEW_SPANS
    pairs = found.join(F.broadcast(hashed) if small else hashed, "_h").select("_s", "_t").distinct()
    met = pairs.join(spans, "_s").join(texts, "_t").where(F.contains("_text", F.col("_span")))
    short = spans.join(known.where("_n <= 0").select("_s"), "_s", "left_semi")
    rest = texts.join(short, F.contains(F.col("_text"), F.col("_span")))
    return met.select("_item", "_key").unionByName(rest.select("_item", "_key")).toDF(item, key)


def owner_of(offsets: DataFrame, starts: DataFrame, at: str = "at", start: str = "start", ranges: int | None = None) -> DataFrame:
    """Each offset with the row of the greatest start at or before it (an as-of join); offsets before all starts go.

    Both tables are laid in one line and cut at quantiles of both, so ranges hold equal numbers of rows;
    each is searched on its own and handed the last start of those before it, one row a range.
    """
    ranges = ranges or 4 * int(offsets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = offsets.select(F.col(at).alias("_x"), F.lit(1).alias("_kind"), F.struct(*offsets.columns).alias("_row"), F.lit(None).cast(starts.schema.simpleString()).alias("_own"))
    line = line.unionByName(starts.select(F.col(start).alias("_x"), F.lit(0).alias("_kind"), F.lit(None).cast(offsets.schema.simpleString()).alias("_row"), F.struct(*starts.columns).alias("_own")))
    places = offsets.select(F.col(at).alias("_x")).unionByName(starts.select(F.col(start).alias("_x")))
    cuts = places.agg(F.percentile_approx("_x", [k / ranges for k in range(1, ranges)], 10_000)).first()[0] or []
    bounds = F.array(*map(F.lit, sorted(set(cuts)))) if cuts else F.array().cast("array<long>")
    ranged = line.withColumn("_range", F.size(F.filter(bounds, lambda b: b <= F.col("_x"))))
    last = ranged.groupBy("_range").agg(F.max_by("_own", F.when(F.col("_kind") == 0, F.col("_x"))).alias("_last"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # at most as many rows as ranges
    carried = last.select("_range", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    inside = Window.partitionBy("_range").orderBy("_x", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("_here", F.last("_own", ignorenulls=True).over(inside)).where("_kind = 1").join(F.broadcast(carried), "_range")
    return placed.withColumn("_owner", F.coalesce("_here", "_carried")).where("_owner is not null").select("_row.*", "_owner.*")


# Duplicates -------------------------------------------------------------------------------------


def first_wins(rows: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """One row for each key across the corpus, the first in this order."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_n", rank).where("_n = 1").drop("_n")


def near_duplicates(rows: DataFrame, group: str, order: str, tokens: Column, threshold: float = NEAR_DUPLICATE) -> DataFrame:
    """(group, order, keep): in a group, a row goes if its token set is too like that of one kept before it.

    A group is read in order as a stream; only the sets that were kept are in memory, found again by their
    first tokens in one fixed order: sets that are alike share one of those. The threshold is over 0.
    """
    sets = rows.select(F.col(group).alias("g"), F.col(order).alias("o"), F.array_sort(F.array_distinct(tokens)).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept, held = None, [], {}
        for b in batches:
            keep = []
            for g, row in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if now != (g,):
                    now, kept, held = (g,), [], {}
                t = frozenset(row)
                # As many tokens must be shared at least; a little less for what floating point adds.
                first = row[: len(row) - math.ceil(threshold * len(row) - 1e-9) + 1]
                like = {k for x in first for k in held.get(x, ())}
                new = not any(len(t & kept[k]) / len(t | kept[k]) >= threshold for k in like)
                keep.append(new)
                if new:
                    for x in first:
                        held.setdefault(x, []).append(len(kept))
                    kept.append(t)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keep)], ["g", "o", "keep"])

    kinds = {f.name: f.dataType.simpleString() for f in sets.schema}
    found = sets.repartition("g").sortWithinPartitions("g", "o").mapInArrow(run, f"g {kinds['g']}, o {kinds['o']}, keep boolean")
    return found.toDF(group, order, "keep")


def exact_sample(rows: DataFrame, key: str, n: int, seed: int = 1977) -> DataFrame:
    """Just n rows, the same ones each time: those of the least hashes."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string"))), key).limit(n).orderBy(key)


def reject_samples(rows: DataFrame, reason: str, order: str, n: int = SAMPLES_PER_REASON) -> DataFrame:
    """The first n rows of each kind of reason (what stands before a colon)."""
    kind = F.split_part(F.col(reason), F.lit(":"), F.lit(1))
    return rows.where(F.col(reason).isNotNull()).withColumn("kind", kind).withColumn("nth", F.row_number().over(Window.partitionBy("kind").orderBy(order))).where(F.col("nth") <= n)


# Reports ----------------------------------------------------------------------------------------


def inventory(docs: DataFrame, by: str = "source", text: str = "text", derived: Column | None = None) -> DataFrame:
    """Documents and bytes of each source and in all; derived sources are listed but not in the total."""
    own = F.lit(True) if derived is None else ~derived
    rows = docs.groupBy(by).agg(F.count("*").alias("documents"), F.sum(F.octet_length(text)).alias("bytes"), F.bool_and(own).alias("own"))
    total = rows.where("own").agg(F.lit("total").alias(by), F.sum("documents").alias("documents"), F.sum("bytes").alias("bytes"))
    return rows.drop("own").unionByName(total).withColumn("tokens", F.floor(F.col("bytes") / T.CHARS_PER_TOKEN).cast("long"))


def histograms(records: DataFrame, fields: list[str], source: str) -> DataFrame:
    """(field, value, records, sources) of each field's values, unknown where missing, in one pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("unknown")).alias("value")) for f in fields]))
    return records.select(source, pairs.alias("p")).groupBy("p.field", "p.value").agg(F.count("*").alias("records"), F.countDistinct(source).alias("sources"))


def ledger_report(ledger: DataFrame, item: str, error: str) -> DataFrame:
    """(reason, failures, items, ignored): reasons up to a colon, 40 characters at most; faults of the account are ignored ones."""
    fatal = F.col(error).rlike(FATAL)
    reason = F.left(F.split_part(F.col(error), F.lit(":"), F.lit(1)), F.lit(40))
    return ledger.groupBy(reason.alias("reason")).agg(F.count_if(~fatal).alias("failures"), F.countDistinct(F.when(~fatal, F.col(item))).alias("items"), F.count_if(fatal).alias("ignored"))


def shares(rows: DataFrame, by: str) -> DataFrame:
    """Count and percentage of each value, and a total row."""
    counted = rows.groupBy(by).agg(F.count("*").alias("n"))
    total = counted.agg(F.lit("total").alias(by), F.sum("n").alias("n"), F.lit(100.0).alias("share"))
    return counted.withColumn("share", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))), 4)).unionByName(total)


def top_values(rows: DataFrame, by: str | Column, k: int = 4) -> DataFrame:
    return rows.groupBy(T.col(by).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def estimate(work: DataFrame, by: str, chars: str, prompt_chars: int = 0, out_ratio: float | Column = 1.0, per_request: int = 20, rates: dict[str, float] = RATES) -> DataFrame:
    """Requests, tokens and cost of each view, and a TOTAL row."""
    ratio = out_ratio if isinstance(out_ratio, Column) else F.lit(out_ratio)
    per = work.groupBy(by).agg(F.count("*").alias("requests"), F.sum(chars).alias("chars"), F.sum(F.col(chars) * ratio).alias("_out"))
    per = per.select(
        by, "requests", "chars", (F.col("chars") / T.CHARS_PER_TOKEN + F.col("requests") * prompt_chars / T.CHARS_PER_TOKEN + per_request * F.col("requests")).alias("tokens_in"), (F.col("_out") / T.CHARS_PER_TOKEN).alias("tokens_out")
    )
    total = per.agg(F.lit("TOTAL").alias(by), *[F.sum(c).alias(c) for c in ("requests", "chars", "tokens_in", "tokens_out")])
    return per.unionByName(total).withColumn("cost", (F.col("tokens_in") * rates["in"] + F.col("tokens_out") * rates["out"]) / 1e6)


def progress(done: Column, todo: Column) -> Column:
    """Percentage done, never over 99.9 while anything is left."""
    share = F.when(done + todo > 0, 100.0 * done / (done + todo)).otherwise(F.lit(100.0))
    return F.when(todo > 0, F.least(share, F.lit(99.9))).otherwise(share)


def rate_between(snapshots: DataFrame, at: str, n: str) -> DataFrame:
    """Change of a count since the snapshot before, by second."""
    w = Window.orderBy(at)
    seconds = F.col(at).cast("timestamp").cast("double") - F.lag(F.col(at).cast("timestamp").cast("double")).over(w)
    return snapshots.withColumn("rate", (F.col(n) - F.lag(n).over(w)) / seconds)


def tallies(rows: DataFrame, *by: str) -> DataFrame:
    """Counts by status, tag or view."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def written_per_view(views: DataFrame, outputs: DataFrame, view: str = "view") -> DataFrame:
    """Every configured view with the number of documents written for it."""
    return views.join(tallies(outputs, view), view, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def coverage(questions: DataFrame, articles: DataFrame, answers: DataFrame, source: str = "source", q: str = "q") -> DataFrame:
    """One row: records, articles with a question in percent, questions with an answer in percent."""
    done = answered(questions, answers, q).agg(F.count("*").alias("records"), F.countDistinct(source).alias("sources"), F.round(100 * F.avg(F.col("answered").cast("int")), 4).alias("answered"))
    return done.join(articles.agg(F.countDistinct(source).alias("articles")), how="inner", on=F.lit(True)).withColumn("covered", F.round(100 * F.col("sources") / F.col("articles"), 4))


def observed(rows: DataFrame, name: str, **metrics: Column):
    """(rows, observation): run counters that a retried task does not count twice."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return rows.observe(seen, *[m.alias(k) for k, m in metrics.items()]), seen


def unknown_names(wanted: list[str], known: list[str]) -> list[str]:
    return sorted(set(wanted) - set(known))
