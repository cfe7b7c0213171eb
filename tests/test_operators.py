import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import gates as G
from textloom.operators import search as S
from textloom.operators import shards as H
from textloom.operators import tables as B
from textloom.operators.package import article_document, document_rows, file_name, sft_rows


def reasons(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_rewrite_reasons(spark):
    view = G.View("v", min_out_chars=10, max_out_ratio=1.5)
    packed = "The Ship was built in 19 BBY. " * 3
    outs = ["", "I cannot do that", "The Ship", "Other things entirely here", "This article says the Ship flew.", "The Ship was built in 20 BBY.", "The Ship " * 40, "The Ship was built in 19 BBY."]
    got = reasons(spark, [(o, packed, "The Ship") for o in outs], "o string, p string, t string", G.rewrite_reason("o", "p", "t", view))
    assert got[0] == "empty response" and got[1] == "refusal" and got[2] == "too short (8 chars)" and got[3] == "subject missing"
    assert got[4].startswith("meta-talk") and got[5] == "date not in source: 20bby" and got[6].startswith("length ratio") and got[7] is None


def test_answer_reasons(spark):
    rows = [("",), ("x" * 4001,), ("According to the article, yes.",), ("His fate was never recorded.",), ("He lived in a house.",)]
    assert reasons(spark, rows, "a string", G.answer_reason("a", 1)) == ["empty answer", "answer too long", "persona leak: according to the article", "declined a recorded fact", None]
    assert reasons(spark, rows[-1:], "a string", G.answer_reason("a", 0)) == ["no tools used"]
    kept = "Let me explain. " + "It was a fine day. " * 6
    assert reasons(spark, [(kept,)], "a string", G.strip_preamble("a"))[0].startswith("It was")
    assert reasons(spark, [("Yes.\n\nSources: a, b",)], "a string", G.strip_citations("a")) == ["Yes."]


def test_question_reasons(spark):
    passage = "Galen Marek was the apprentice of Darth Vader. He trained for 12 years aboard the ship called Executor."
    rows = [
        ("Galen Marek lived", "x"), ("Who?", "x"), ("What does the passage say of Galen?", "x"), ("Who trained Galen Marek?", ""), ("Who trained Galen Marek?", "short"), ("Who trained Galen Marek?", "nothing like this is there"),
        ("Who trained Luke Skywalker?", "Galen Marek was the apprentice"), ("Did Galen Marek train for 15 years?", "Galen Marek was the apprentice"), ("Who trained Galen Marek?", "Galen Marek was the apprentice"),
        ("How long did he train there?", "Galen Marek was the apprentice"),
    ]
    got = reasons(spark, [(q, e, "Ship", passage) for q, e in rows], "q string, e string, t string, p string", G.question_reason("q", "e", "t", "p"))
    assert got == ["not a question", "length", "meta-reference", "no evidence", "evidence too short", "evidence not in passage", "name not in article: Luke Skywalker", "number not near evidence", None, "pronoun subject"]


def test_terms(spark):
    row = [("When Thrawn met Pellaeon in 9 ABY, Ackbar fled.", "Who is it?", "Thrawn", "thrawn and pellaeon, 9 aby")]
    assert reasons(spark, row, "a string, q string, t string, r string", G.unsupported_terms("a", "q", "t", "r")) == [["Ackbar"]]


def test_parse_questions(spark):
    text = '```\n1. factoid | Who? | "He"\n- date | When?\nWhat | because\n* odd | Why? | so\n\nPlain?\n```'
    got = spark.createDataFrame([(text,)], "t string").select(F.inline(G.parse_questions("t"))).collect()
    assert [tuple(r) for r in got] == [("factoid", "Who?", "He"), ("date", "When?", ""), ("other", "What", "because"), ("other", "Why?", "so"), ("other", "Plain?", "")]


def test_eligibility(spark):
    body = "word " * 100
    view = G.View("v", continuity=("canon",), require_pattern="WORD")
    rows = [("short", "canon"), (body[:200], "canon"), (body, "legends"), ("text " * 100, "canon"), (body, "canon"), ("- a\n" * 60, "canon"), ("| a |\n" * 60, "canon")]
    assert reasons(spark, rows, "b string, c string", G.eligible("b", "c", view)) == ["too short", "too short for view", "continuity excluded", "pattern not found", None, "index list", "table only"]


def test_eligibility_reads_an_article_once(spark):
    views = (G.View("a"), G.View("b", require_pattern="word"), G.View("c", min_body_chars=9, continuity=("canon",)))
    rows = spark.createDataFrame([("word " * 100, "canon"), ("| a |\n" * 60 + "text " * 50, "legends")], "b string, c string")
    found = rows.select(G.eligibility("b", "c", views).alias("r"))
    assert [r.r for r in found.collect()] == [[None, None, None], ["too short for view", "too short for view", "continuity excluded"]]
    # What takes a text apart is in the plan once for all views; before, several times for each.
    assert found._jdf.queryExecution().analyzed().toString().count("translate(") == 1


def test_search(spark):
    docs = spark.createDataFrame([(1, "Alpha", "aaaaa aa"), (2, "aa Beta", "one aa\ntwo"), (3, "c", "none")], "id long, name string, text string")
    got = S.search_text(docs, "aa", "name", "id").collect()
    assert [(r.id, r.hits, r.score, r.snippet) for r in got] == [(2, 1, 31, "one aa"), (1, 3, 3, "aaaaa aa")]
    assert S.search_text(docs, "  ", "name", "id").count() == 0
    names = S.search_titles(docs, "beta aa", "name", "id").collect()
    assert [(r.id, r.score) for r in names] == [(2, 40)]
    assert S.search_titles(docs, "?!", "name", "id").count() == 0
    assert [r.kind for r in S.read_article(docs, "aa beta", "name", "text", "id").collect()] == ["article"]
    assert [r.title for r in S.read_article(docs, "beta", "name", "text", "id").collect()] == ["aa Beta"]
    counted = S.count_matches(docs, "a", cap=2).collect()
    assert {r.id: (r.hits, r.capped) for r in counted} == {1: (7, True), 2: (2, True)}


def test_near_duplicates_compare_with_kept_only(spark):
    rows = [(1, 1, "a b c d"), (1, 2, "a b c e"), (1, 3, "a b e f"), (1, 4, ""), (1, 5, ""), (2, 1, "a b c d")]
    got = B.near_duplicates(spark.createDataFrame(rows, "g long, o long, t string"), "g", "o", T.token_set("t", ()), 0.6).orderBy("g", "o").collect()
    assert [r.keep for r in got] == [True, False, True, True, True, True]


@pytest.mark.parametrize("threshold", [0.2, 0.6, 0.8, 1.0])
def test_near_duplicates_against_all_kept(spark, threshold):
    r = random.Random(7)
    rows = [(r.choice([1, 1, 1, 2, None]), k, " ".join(r.choice("abcdefgh") for _ in range(r.randint(0, 6)))) for k in range(200)]
    got = {x.o: x.keep for x in B.near_duplicates(spark.createDataFrame(rows, "g long, o long, t string"), "g", "o", F.filter(F.split("t", " "), lambda w: w != ""), threshold).collect()}
    kept = []
    for g, o, t in rows:
        t = set(t.split())
        new = not any(g == h and t | k and len(t & k) / len(t | k) >= threshold for h, k in kept)
        assert got[o] == new
        if new:
            kept.append((g, t))


def test_greedy_shards_forget_what_goes_over(spark):
    r = random.Random(1)
    rows = [("s" + str(k % 2), k, "x" * r.randint(0, 50)) for k in range(300)]
    df = spark.createDataFrame(rows, "s string, k long, text string")
    got = {(x.s, x.k): x.shard for x in H.greedy_shards(df, "s", "k", H.row_bytes(df), 100).collect()}
    for s in ("s0", "s1"):
        shard = held = 0
        for g, k, t in sorted(rows):
            if g == s:
                assert got[g, k] == shard
                held += len(t)
                if held >= 100:
                    shard, held = shard + 1, 0
    zero = H.greedy_shards(df, "s", "k", H.row_bytes(df), 0)
    assert zero.groupBy("s", "shard").count().where("count > 1").count() == 0


@pytest.mark.parametrize("budget", [0, 1, 37, 1000, 10**9])
def test_greedy_shards_of_one_group_in_many_blocks(spark, budget):
    """One source holds most rows; sizes are null or nothing, orders and groups null or repeated."""
    r = random.Random(budget)
    rows = [(r.choice(["big"] * 8 + ["a", None]), r.choice([None, *range(400)]), r.choice([None, 0, 1, 5, 5, 40, 2000])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "s string, k long, n long").repartition(5)
    got = Counter((x.s, x.k, x.bytes, x.shard) for x in H.greedy_shards(df, "s", "k", "n", budget).collect())
    want, least = Counter(), lambda x: (x is not None, x or 0)
    for s in {s for s, _, _ in rows}:
        shard = held = 0
        for _, k, n in sorted((x for x in rows if x[0] == s), key=lambda x: (least(x[1]), least(x[2]))):
            want[s, k, n, shard] += 1
            held += n or 0
            if held >= budget:
                shard, held = shard + 1, 0
    assert got == want
    assert H.greedy_shards(df.limit(0), "s", "k", "n", budget).count() == 0


def test_block_tables_answer_for_every_entry():
    r = random.Random(3)
    for budget in (1, 7, 20):
        sizes = [r.choice([0, 0, 1, 3, 9, 25]) for _ in range(60)]
        total, need, closed, held = H.block_table(np.array(sizes, np.int64), budget)
        for entry in range(budget):
            shards, now = 0, entry
            for n in sizes:
                now += n
                if now >= budget:
                    shards, now = shards + 1, 0
            k = next((k for k, least in enumerate(need) if least <= entry), None)
            assert (shards, now) == ((0, entry + total) if k is None else (closed[k], held[k]))


def test_owner_of(spark):
    r = random.Random(2)
    starts = sorted({r.randint(0, 9_000_000) for _ in range(40)})
    at = [r.randint(0, 9_900_000) for _ in range(300)]
    got = {x.at: x.start for x in B.owner_of(spark.createDataFrame([(x,) for x in at], "at long"), spark.createDataFrame([(x,) for x in starts], "start long")).collect()}
    for x in at:
        below = [s for s in starts if s <= x]
        assert got.get(x) == (below[-1] if below else None)


def test_degraded(spark):
    rows = [(1, True, 60, True), (1, False, 40, True), (2, True, 10, True), (2, False, 90, True), (3, False, 5, False)]
    got = {r.d: r.rejected for r in G.degraded(spark.createDataFrame(rows, "d long, f boolean, c long, s boolean"), "d", "f", "c", "s").collect()}
    assert got == {1: True, 2: False, 3: False}


def test_packaging(spark):
    text = '---\ntitle: "A \\"B\\""\ncontinuity: canon\nparaphrased_from: w/x.md\n---\n\nBody text.\n'
    files = spark.createDataFrame([("A/x_y.md", text), ("e.md", "---\ntitle: \"E\"\n---\n"), ("b/book.txt", "plain")], "path string, text string")
    got = {r.doc_id: r for r in document_rows(files, "src", "L", "https://x/").collect()}
    assert set(got) == {"src/A/x_y.md", "src/b/book.txt"}
    assert got["src/A/x_y.md"].derived_from == "w/x.md" and got["src/A/x_y.md"].categories == [] and "*src · Canon*" in got["src/A/x_y.md"].text
    assert got["src/b/book.txt"].title == "book" and got["src/b/book.txt"].continuity is None
    sft = sft_rows(spark.createDataFrame([("q", "a")], "q string, a string"), "p").first()
    assert [m.role for m in sft.messages] == ["system", "user", "assistant"] and sft.unsupported == [] and sft.tools == 0
    row = spark.range(1).select(file_name(F.lit("9: a/b")).alias("n"), article_document(F.lit('T"x'), F.lit("canon"), F.lit("s"), F.array(F.lit("c")), F.lit(""), F.lit("b")).alias("d")).first()
    assert row.n == "9/9__a_b.md" and row.d == '---\ntitle: "T\\"x"\ncontinuity: canon\nsource: s\ncategories:\n  - "c"\n---\n\nb\n'
