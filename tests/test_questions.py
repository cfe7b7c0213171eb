"""Rules on rows that the given tables do not hold."""

from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from textloom.functions import markdown as M
from textloom.functions import text as T
from textloom.operators import questions as Q
from textloom.operators import search as S
from textloom.operators import tables as B
from textloom.sources.sinks import build_totals, datasheet, write_shards


def test_two_decimals_round_the_binary_value(spark):
    given = [8.425, 1.625, 1.015, 1.125, 2.675, 0.005, 0.0, 0.125, 0.375, 99.995, 674 / 80, 1 / 3, 12345.675, 1.0]
    got = spark.createDataFrame([(x,) for x in given], "x double").select("x", T.two_decimals(F.col("x")).alias("s")).collect()
    for r in got:
        assert r.s == str(Decimal(r.x).quantize(Decimal("0.01"), ROUND_HALF_EVEN)) == f"{r.x:.2f}"


def test_shards_keep_rows_of_null_and_repeated_keys(spark, tmp_path):
    rows = spark.createDataFrame([("a", "one"), ("a", "two"), ("b", "three"), (None, "four"), ("b", "three")], "doc_id string, text string")
    files = write_shards(rows, str(tmp_path), "s", "doc_id", budget=6)
    assert sorted((r.doc_id or "", r.text) for r in spark.read.parquet(*files).collect()) == [("", "four"), ("a", "one"), ("a", "two"), ("b", "three"), ("b", "three")]
    assert len(files) > 1 and not write_shards(rows.limit(0), str(tmp_path), "none", "doc_id")


def test_evidence_pairs_are_those_of_containment(spark):
    texts = [(1, "the quick brown fox jumps over the lazy dog at noon"), (2, "  "), (3, ""), (None, "quick brown fox"), (1, "xthe quick brown foxy"), (5, None), (6, "a  b\tc d e f g h i j")]
    spans = [(1, ""), (2, " "), (3, "quick brown fox"), (4, "he quick brown f"), (5, "brown fox jumps over the lazy dog"), (6, None), (7, "b\tc d e f g h"), (3, "quick brown fox"), (8, "fox")]
    want = sorted(((i, k) for i, s in spans if s is not None for k, t in texts if t is not None and s in t), key=repr)
    got = B.evidence_pairs(spark.createDataFrame(spans, "item int, span string"), spark.createDataFrame(texts, "key int, text string"), "item", "span", "text")
    assert sorted(((r.item, r.key) for r in got.collect()), key=repr) == want


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_owner_of_is_the_last_start(spark, ranges):
    starts, offsets = [5, 7, 7, 40, 1 << 54, (1 << 54) + 1], [0, 5, 6, 7, 39, 41, 1 << 54, (1 << 54) + 1, 1 << 60]
    got = B.owner_of(spark.createDataFrame([(x,) for x in offsets], "at long"), spark.createDataFrame([(x,) for x in starts], "start long"), ranges=ranges)
    assert sorted((r["at"], r["start"]) for r in got.collect()) == [(x, max(s for s in starts if s <= x)) for x in offsets if x >= 5]


def test_search_folds_ascii_only(spark):
    df = spark.createDataFrame([("KING king King",), ("İn in",), ("ÉT ét",)], "text string")
    assert [r.hits or 0 for r in df.select(S.match_count("text", "KING").alias("hits")).collect()] == [2, 0, 0]
    assert [r.hits for r in df.select(S.match_count("text", "in").alias("hits")).collect()] == [3, 1, 0]
    assert [r.hits for r in df.select(S.match_count("text", "ÉT").alias("hits")).collect()] == [0, 0, 1]


def test_all_references_are_decoded(spark):
    text = spark.createDataFrame([("a&nbsp;b &Eacute;&#x41;&#66; &amp;lt; &hearts; &nope;",), (None,)], "t string")
    assert [r.x for r in text.select(M.unescape("t").alias("x")).collect()] == ["a b ÉAB &lt; ♥ &nope;", None]


def test_sources(spark):
    known = spark.createDataFrame([("a", "x", False, None), ("b", "x", True, None)], "name string, license string, restricted boolean, derived_from string")
    assert [r.name for r in Q.select_sources(known).collect()] == ["a"] and Q.select_sources(known, ["b"]).count() == 0 and Q.select_sources(known, ["b"], restricted=True).count() == 1
    with pytest.raises(ValueError, match="unknown sources: c"):
        Q.select_sources(known, ["a", "c"])


def test_paraphrase_estimate_counts_prose_only(spark):
    body = "word " * 60 + "\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n" + "more " * 60
    rows = spark.createDataFrame([(body,), ("short",), (body,)], "body string")
    r = Q.paraphrase_estimate(rows, "body", system_chars=360).first()
    assert (r.articles, r.usable, r.requests, r.chars) == (3, 2, 4, 1200)
    assert abs(r.tokens_in - (r.chars / 3.6 + 4 * 100 + 4 * 20)) < 1e-6 and abs(r.tokens_out - r.chars / 3.6) < 1e-6


def test_condense_of_many_sections(spark):
    text = "Lead. " * 50 + "".join(f"\n## Part {k}\n\n" + "Sentence here. " * 40 for k in range(60))
    out = spark.createDataFrame([(text,)], "t string").select(M.condense("t", 4000).alias("x")).first().x
    assert len(out) <= 4000 and out.startswith("Lead.") and "## Part 5" in out


def test_datasheet_is_made_of_build_statistics():
    stats = [{"source": "small", "rows": 1, "files": 1, "raw_bytes": 360}, {"source": "large", "rows": 1500, "files": 2, "raw_bytes": 3240}]
    assert build_totals(stats, 1200) == {"rows": 1501, "tokens": 1000, "raw_bytes": 3600, "disk_bytes": 1200, "ratio": 3.0} and build_totals([], 0)["ratio"] == 0.0
    made = datasheet(stats, "A set", {"train": {"rows": 200, "files": 1, "raw_bytes": 999, "flagged": 3}, "eval": {"rows": 0, "files": 0, "raw_bytes": 0}}, {"large": "CC"})
    assert "1,501 documents, about 1.0K tokens." in made and made.index("- large: 1,500 documents, 3.2 kB (90.0%), CC") < made.index("- small: 1 documents, 360 B (10.0%), license unknown")
    assert "| train | 200 | 1 | 999 B | 3 (1.5%) |" in made and "| eval | 0 | 0 | 0 B | 0 (0.0%) |" in made
