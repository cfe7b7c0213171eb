from pyspark.sql import functions as F

from textloom.functions import markdown as M
from textloom.functions import wikitext as W
from textloom.operators import gates as G
from textloom.operators import search as S
from textloom.operators import tables as B

PAGE = """{{Top|leg}}{{Character
|name=Some [[One|Person]]<ref>x</ref>
|image=[[File:a.jpg]]
|birth=19 [[BBY]]{{C|about}}
|species=[[Human]]
|gender=Male
|hair=Black<br/>Grey
|affiliation=
*[[A]]
**B
|masters=
|era=Rise
}}
'''Some Person''' was ''a'' {{C|great}} pilot.<!-- no -->{{Cite web|x={{y}}}}[[File:b.jpg|thumb|a [[link]]]]
== Life ==
* one
** two
{{Unknown|x}}
[[Category:People|Person]]
{|
! H !! I
|-
| a || b
|}
"""


def test_page():
    box = W.infobox(PAGE)
    assert box == "## Infobox\n- **Name:** Some Person\n- **Born:** 19 BBY(about)\n- **Species:** Human\n- **Gender:** Male\n- **Hair:** Black / Grey\n- **Affiliations:**\n  - A\n    - B\n- **Era:** Rise\n"
    assert W.to_markdown(PAGE) == "**Some Person** was *a* great pilot.\n\n## Life\n\n- one\n  - two\n\n| H | I |\n| --- | --- |\n| a | b |"
    assert W.infobox("{{Short|a=1}}") == "" and W.to_markdown("{{open") == "{{open"


def test_columns(spark):
    row = spark.createDataFrame([(PAGE,), (None,)], "t string").select(W.infobox_of("t").alias("b"), W.markdown_of("t").alias("m")).collect()
    assert row[0].b.startswith("## Infobox") and (row[1].b, row[1].m) == ("", "")


def test_plans(spark):
    text = "lead\n## A\n\n" + "x" * 50 + "\n## B\n"
    df = spark.createDataFrame([("## Infobox\n- a\n", text)], "b string, t string")
    assert df.select(M.plan_chunks("b", "t", 30)).first()[0] == ["## Infobox\n- a\n\nlead", "## A", "x" * 50, "## B\n"]
    assert df.select(M.skeleton("b", "t", 10, part=5)).first()[0] == "## Infobox\n- a\n\nlead\n\n## A\n\nxxxxx\n\n## B"
    assert df.select(M.skeleton("b", "t")).first()[0] is None


def test_reports(spark, tmp_path):
    tries = spark.createDataFrame([(1, 0, 1, 10), (1, 1, 5, 10), (1, 2, 9, 10), (2, 0, 1, 10), (2, 1, 3, 10)], "d long, a long, k long, n long")
    assert {r.d: r.a for r in G.best_batch(tries, "d", "a", "k", "n").collect()} == {1: 1, 2: 1}
    views = spark.createDataFrame([("a",), ("b",)], "view string")
    assert {r.view: r.n for r in B.written_per_view(views, views.where("view = 'a'")).collect()} == {"a": 1, "b": 0}
    q = spark.createDataFrame([("Who is A?", "s"), ("Who?", "t")], "q string, source string")
    got = B.coverage(q, spark.createDataFrame([("s",), ("t",), ("u",), ("v",)], "source string"), spark.createDataFrame([("who IS a",)], "q string")).first()
    assert (got.records, got.answered, got.covered) == (2, 50.0, 50.0)
    rows, seen = B.observed(q, "run", n=F.count("*"))
    rows.count()
    rows.collect()
    assert seen.get["n"] == 2
    docs = spark.createDataFrame([(1, "k", "ABC")], "id long, name string, text string")
    assert S.build_index(docs, str(tmp_path / "i"), "id", "name").first().folded == "abc"
    more = docs.unionByName(spark.createDataFrame([(2, "l", "D")], docs.schema))
    assert S.build_index(more, str(tmp_path / "i"), "id", "name").count() == 2
