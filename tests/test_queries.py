from hashlib import md5 as _md5

import pytest

from tests.parity import both
from textloom.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def md5(text: str) -> str:
    return _md5(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    got, want = both(spark, SF, QUERIES[name], ORACLE_SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_normalizers_read_whole_texts(spark, tmp_path):
    texts = ["A_b * " * 100 + end for end in ("one", "two")]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.title_key, r.match_key) for r in QUERIES["normalizers"](spark, str(tmp_path)).collect()}
    assert got == {k: (md5(f"{'a b ' * 100}{e}"), md5(f"{'a b ' * 100}{e}")) for k, e in enumerate(("one", "two"))}


def test_view_eligibility_strips_tables(spark, tmp_path):
    text = "Lead. " * 30 + "\n\n| a | b |\n|---|---|\n" + "| tion of | x |\n" * 80
    spark.createDataFrame([(text, "en")], "text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.view: r.reason for r in QUERIES["view_eligibility"](spark, str(tmp_path)).collect()}
    assert got == {v: "too short for view" for v in ("inuniverse", "timeline", "quiz", "summary")}


def test_question_gate_looks_for_evidence_in_whole_passages(spark, tmp_path):
    asked = "where did Captain Moro find the hidden silver lantern of the harbour"
    answer = "It was found long ago below the old tower by the people of the coast. " * 3 + "Captain Moro found the hidden silver lantern at the harbour."
    data = [(1, 0, "user", asked), (1, 1, "assistant", answer), (2, 0, "user", asked), (2, 1, "assistant", f"{answer} So {asked} is told.")]
    spark.createDataFrame(data, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.conv_id, r.evidence): r.reason for r in QUERIES["question_gate"](spark, str(tmp_path)).collect()}
    assert got == {(1, "answer"): "keep", (1, "asked"): "evidence not in passage", (2, "answer"): "keep", (2, "asked"): "keep"}
