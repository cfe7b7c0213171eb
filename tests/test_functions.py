import pytest
from pyspark.sql import functions as F

from textloom.functions import markdown as M
from textloom.functions import text as T

ARTICLE = '---\ntitle: "The Ship"\ncontinuity: canon\nsource: x\ncategories:\n  - "A"\n  - "B"\n---\n\n## Infobox\n- **Key:** v\n  - more\n\nThe lead paragraph.\n\n## Life\n\nText.\n\n## Gallery\n\n### Empty\n\n'


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expr).first()[0]


def test_document_parts(spark):
    assert one(spark, M.frontmatter("t"), t=ARTICLE).startswith("---\ntitle")
    assert one(spark, M.infobox("t"), t=ARTICLE) == "## Infobox\n- **Key:** v\n  - more\n"
    assert one(spark, M.body("t"), t=ARTICLE) == "The lead paragraph.\n\n## Life\n\nText."
    front = M.frontmatter("t")
    assert one(spark, M.front_scalar(front, "title"), t=ARTICLE) == "The Ship"
    assert one(spark, M.front_list(front, "categories"), t=ARTICLE) == ["A", "B"]


@pytest.mark.parametrize(
    "text,kept",
    [
        ("## A\n\n### B\n\n## C\nx", "## C\nx"), ("## A\n### B\ny", "## A\n### B\ny"), ("#### A\n\n## B\n", ""), ("x\n## A\n## B\nz", "x\n## B\nz"), ("", ""), ("## A\n### B\n### C\nt\n## D", "## A\n### C\nt"),
        ("###### A\n##### B\n#### C\n### D\n## E\n", ""),
    ],
)
def test_empty_sections(spark, text, kept):
    assert one(spark, M.strip_empty_sections("t"), t=text) == kept


def test_segments_and_tables(spark):
    text = "a\n\n| x | y |\n| 1 | 2 |\n\n| 3 | 4 |\nb\n<table>\n<tr><td>1</td>\n</table>"
    assert one(spark, M.segments("t"), t=text) == ["a", "| x | y |\n| 1 | 2 |\n\n| 3 | 4 |", "b", "<table>\n<tr><td>1</td>\n</table>"]
    assert one(spark, M.is_table("t"), t="| a |\n\n| b |") is True
    assert one(spark, M.is_table("t"), t="") is False
    assert one(spark, M.strip_tables("t"), t=text) == "a\n\nb"
    assert one(spark, M.prose_chars("t"), t=text) == 2


def test_chunks(spark):
    text = "lead\n## One\n\n" + "x" * 30 + "\n\n" + "y" * 30 + "\n## Two\n\nz"
    assert one(spark, M.chunks("t", 40), t=text) == ["lead", "## One\n\n" + "x" * 30, "y" * 30, "## Two\n\nz"]
    assert one(spark, M.chunks("t", 400), t=text) == [text]
    assert one(spark, M.chunks("t", 10), t="  ") == []
    assert one(spark, M.chunks("t", 10), t="| a |\n" * 20) == ["\n".join(["| a |"] * 20)]


def test_context(spark):
    assert one(spark, M.chunk_context(F.col("p"), F.col("c"), 20), p="First one here. Second one.", c="next") == "Second one."
    assert one(spark, M.chunk_context(F.col("p"), F.col("c")), p="First. Second.", c="## head") == ""
    assert one(spark, M.chunk_context(F.col("p"), F.col("c")), p="| t |", c="next") == ""


def test_condense_keeps_every_heading(spark):
    text = "Lead sentence. " * 30 + "".join(f"\n## Section {k}\n\n" + "Words here. " * 20 for k in range(40))
    out = one(spark, M.condense("t", 3000), t=text)
    assert len(out) <= 3000 and "## Section 39" in out
    assert one(spark, M.condense("t", 3000), t="short") == "short"


@pytest.mark.parametrize("text,limit,out", [("One. Two. Three", 10, "One. Two."), ("abcdef", 3, "abc"), ("abc", 3, "abc"), ("a. bcdefghij", 8, "a. bcdef"), ("abc", 0, ""), ("abc", -4, "")])
def test_cut(spark, text, limit, out):
    assert one(spark, T.cut("t", limit), t=text) == out


def test_boilerplate(spark):
    text = "a\n## Sources\nx\n### Deep\ny\n## Life\nb\n## Gallery\nz"
    assert one(spark, M.strip_boilerplate("t"), t=text) == "a\n## Life\nb\n"


def test_noise(spark):
    text = '<figure>x</figure>![i](u)<a href="Category:X" class="wikilink">c</a><a class="wikilink" href="y">kept</a> <em>e</em><br/>&amp;lt; \\$5\n- \n\n\n\nend'
    assert one(spark, M.clean_noise("t"), t=text) == "kept *e*\n&lt; $5\nend"


def test_sections(spark):
    text = "lead\n## One\na\n### Sub\nb\n## Two\nc"
    assert one(spark, M.extract_section("t", "one"), t=text) == "## One\na\n### Sub\nb"
    assert one(spark, M.extract_section("t", "sub"), t=text) == "### Sub\nb"
    assert one(spark, M.extract_section("t", "none"), t=text) is None
    assert one(spark, M.section_names("t"), t=text) == ["One", "Two"]
    assert one(spark, M.categories("t"), t="[[Category:A|s]] [[category: B ]] [[Category:A]]") == ["A", "B"]


def test_restore_heading(spark):
    go = lambda s, o: one(spark, M.restore_heading(F.col("s"), F.col("o")), s=s, o=o)
    assert go("## Works\n- a", "- b") == "## Works\n\n- b"
    assert go("## Works\n- a", "## Labour\n- b") == "## Works\n- b"
    assert go("plain", "out") == "out"


def test_scalars(spark):
    assert one(spark, T.normalize_title("t"), t="Battle_of  Yavin (IV)!") == "battle of yavin iv"
    assert one(spark, T.normalize_match("t"), t=" *Rogue*\n One_x ") == "rogue one x"
    assert one(spark, T.era_dates("t"), t="In 25,797 BBY and 19 ABY, 19ABY") == ["25797bby", "19aby"]
    assert one(spark, T.title_present(F.lit("Death Star (novel)"), F.lit("the death  star was"))) is True
    assert one(spark, T.title_present(F.lit("Alpha Beta Gammaword"), F.lit("nothing"))) is False
    assert one(spark, T.occurs_in(F.lit("jedi masters"), F.lit("a jedi master"))) is True
    assert one(spark, T.evidence_window(F.lit("the quick brown fox jumps"), F.lit("x" * 10 + " The *quick* brown fox jumps over"), 5)) == "xxxx the quick brown fox jumps over"
    assert one(spark, T.evidence_window(F.lit("short"), F.lit("short"))) is None
    assert one(spark, T.assign_split(F.lit("p"), 0.0)) == "train"
    assert T.human(1500) == "1.5 kB" and T.compact(2_500_000) == "2.5M"
