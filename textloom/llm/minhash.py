"""One-permutation MinHash fingerprints, in DataFrame operations only.

Each shingle of five words is hashed once; its high bits name one of BINS bins, and a bin keeps its
least hash. An empty bin takes the value of the filled bin that comes first in an order of its own,
drawn by hashing (optimal densification: donors are chosen independently of their neighbourhood, and
alike in all documents). The low BITS bits of each bin are stored. As unequal values agree on these
by chance at a rate of 2**-BITS, likeness is (matches / BINS - 2**-BITS) / (1 - 2**-BITS), at least 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm._common import text_or_empty

WORDS = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 8
_LOWEST = -(1 << 63)


def signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``, an array of BINS low-order values; empty if the text has no words.

    Words are separated by blanks and \\t to \\r. A text of fewer than five words is one shingle.
    """
    s, shift = f"_{out}", 64 - BIN_BITS
    keep = [F.col(f"`{c}`") for c in df.columns]
    words = F.filter(F.split(F.translate(F.col(text), "\t\n\x0b\f\r", "     "), " ", -1), lambda w: w != "")
    df = df.select(*keep, F.transform(words, lambda w: F.xxhash64(w)).alias(f"{s}_w"))
    w = F.col(f"{s}_w")
    shingles = (
        F.when(F.size(w) >= WORDS, F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)])))
        .when(F.size(w) > 0, F.array(F.xxhash64(w)))
        .otherwise(F.array().cast("array<long>"))
    )
    df = df.select(*keep, F.sort_array(shingles).alias(f"{s}_s"))
    s_ = F.col(f"{s}_s")
    df = df.select(*keep, F.filter(s_, lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(s_, i - 1), shift))).alias(f"{s}_v"))
    v = F.col(f"{s}_v")
    df = df.select(*keep, v, F.transform(v, lambda x: F.shiftright(x, shift) + BINS // 2).alias(f"{s}_b"))
    b = F.col(f"{s}_b")

    def place(j: Column) -> Column:
        donor = F.array_min(F.transform(b, lambda x, p: F.xxhash64(j, x).bitwiseAND(F.lit(-BINS)).bitwiseOR(p.cast("long"))))
        own = F.array_position(b, j)
        return F.when(own > 0, own - 1).otherwise(donor.bitwiseAND(F.lit(BINS - 1))).cast("int")

    bins = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")), lambda j: F.get(v, place(j)).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))
    return df.select(*keep, F.when(F.size(v) > 0, bins).otherwise(F.array().cast("array<int>")).alias(out))


def fingerprint(sig: Column) -> Column:
    """The packed values as hexadecimal digits; zeros if there are none."""
    digits = F.array(*[F.lit(f"{k:0{BITS // 4}x}") for k in range(1 << BITS)])
    return F.when(F.size(sig) > 0, F.array_join(F.transform(sig, lambda x: F.get(digits, x)), "")).otherwise("0" * (BINS * BITS // 4))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1; two texts without words are alike, a text with and one without are not."""
    chance = 2.0**-BITS
    matches = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    both = (F.size(a) > 0) & (F.size(b) > 0)
    return F.when(both, F.greatest(F.lit(0.0), (matches / F.lit(float(BINS)) - chance) / (1 - chance))).when(F.size(a) == F.size(b), F.lit(1.0)).otherwise(F.lit(0.0))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, text, signature, fingerprint. A null text is empty."""
    base = docs.select(F.col(id_col), text_or_empty(text_col).alias("text"))
    return signature(base, "text", "signature").withColumn("fingerprint", fingerprint(F.col("signature")))


def with_next(df: DataFrame, id_col: str, take: list[str], tie: str, ranges: int | None = None) -> DataFrame:
    """Adds next_<column> of the next row in descending order of the id; the last row's next is the first row.

    Null ids come last; rows of one id are ordered by a hash of the column ``tie``. Light rows (id and hash)
    are sorted into ranges by Spark, which tells where ranges begin and end, one row a range; whole rows are
    then dealt to these ranges once, and each range also gets the first row of the one that follows.
    """
    ranges = ranges or max(256, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # 32 digits that sort as (id, hash) does.
    digits = lambda x: F.lpad(F.hex(x.bitwiseXOR(F.lit(_LOWEST))), 16, "0")
    at = F.concat(digits(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST))), digits(F.xxhash64(tie)))
    light = df.select(at.alias("at")).repartitionByRange(ranges, "at").withColumn("part", F.spark_partition_id())
    found = light.groupBy("part").agg(F.min("at").alias("low"), F.max("at").alias("high")).orderBy("part").collect()  # one row a range
    lows, highs = (F.split(F.lit(",".join(r[c] for r in found)), ",") for c in ("low", "high"))
    own = F.size(F.filter(lows, lambda x: x <= F.col("_at"))) - 1
    dealt = df.withColumn("_at", at).withColumn("_range", own)
    here = F.struct(F.col("_range").alias("range"), F.lit(False).alias("guest"))
    there = F.struct(F.pmod(F.col("_range") + 1, F.lit(max(1, len(found)))).cast("int").alias("range"), F.lit(True).alias("guest"))
    dealt = dealt.withColumn("_to", F.explode(F.when(F.col("_at") == F.get(highs, F.col("_range")), F.array(here, there)).otherwise(F.array(here))))
    order = Window.partitionBy("_to.range").orderBy("_to.guest", F.desc("_at"))
    return dealt.select(*df.columns, "_to", *[F.lead(c).over(order).alias(f"next_{c}") for c in take]).where(~F.col("_to.guest")).drop("_to")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text and the next document, in descending order of doc_id.

    A null text is empty. Null ids come last, and repeated ids are ordered by a hash of the text, so equal
    rows alone may change places. One document is its own next; an empty table gives an empty one.
    """
    rows = with_next(signature(docs.select("doc_id", text_or_empty().alias("text")), "text", "sig"), "doc_id", ["text", "sig"], "text")
    n, cut = F.char_length("text"), F.floor(F.char_length("text") / 3).cast("int")
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sig", "next_sig", F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut)).alias("edited"))
    rows = signature(rows, "edited", "edited_sig")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint(F.col("sig")).alias("fingerprint"),
        fingerprint(F.col("edited_sig")).alias("edited_fingerprint"), likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
