import hashlib
import json

import pytest
from pyspark.sql import functions as F

from textloom.plans import pretrain, rewrite
from textloom.sources import readers, sinks, views
from textloom.streaming import incremental


def test_article_files_keep_hidden_names(spark, tmp_path):
    for name, text in {"A/a.md": "x", "_/.b.md": "é", "A/manifest.md": "no", "A/c.txt": "no", ".DS_Store": "no"}.items():
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_text(text)
    assert {(r.path, r.text) for r in readers.articles(spark, str(tmp_path)).collect()} == {("A/a.md", "x"), ("_/.b.md", "é")}
    assert [tuple(r) for r in readers.stat_scan(spark, str(tmp_path), (".md",)).collect()] == [(".md", 2, 3)]
    assert readers.articles(spark, str(tmp_path / "none")).count() == 0


def test_folders_below_the_driver_levels_are_listed_in_tasks(spark, tmp_path):
    names = ["a.md", "b/c.md", "b/d/e/f/g.md", "b/d/e/.h/_i/k.md", "x/y/z/w/manifest.md", "x/y/z/w/v.MD"]
    for n in names:
        p = tmp_path / n
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(n)
    want = sorted((n, len(n)) for n in names if "manifest" not in n)
    assert [tuple(r) for r in readers.list_files(spark, str(tmp_path), (".md",)).collect()] == want
    assert [tuple(r) for r in readers.list_files(spark, str(tmp_path), (".md",), limit=2).collect()] == want[:2]
    sums = sinks.write_checksums(spark, tmp_path)
    assert list(sums) == sorted(names) and all(sums[n] == hashlib.sha256(n.encode()).hexdigest() for n in names)
    assert sinks.write_checksums(spark, tmp_path) == sums


def test_json_lines_and_ledger(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"item": "a", "error": "http 402: x"}\n\n{"item": "b", "error": "timeout"}\n{"item": "c", "er')
    assert [r.item for r in readers.ledger(spark, str(tmp_path / "a.jsonl")).collect()] == ["b"]
    (tmp_path / "t.txt").write_text("One\n\n Two \nOne\n")
    assert {r.title for r in readers.title_list(spark, str(tmp_path / "t.txt")).collect()} == {"One", "Two"}


def test_xml_pages(spark, tmp_path):
    page = "<page><title>{}</title><ns>{}</ns>{}<revision><text>old</text></revision><revision><text bytes='1'>{}</text></revision></page>"
    pages = [page.format("A", 0, "", "new"), page.format("T", 1, "", "x"), page.format("R", 0, "<redirect title='A' />", "x"), page.format("E", 0, "", "")]
    (tmp_path / "d.xml").write_text(f"<mediawiki>{''.join(pages)}</mediawiki>")
    assert [tuple(r) for r in readers.xml_pages(spark, str(tmp_path / "d.xml")).collect()] == [("A", "new")]


VIEW = '[defaults]\nuser_template = "{title} {continuity} {text}"\n[views.a]\nout_dir = "o"\nsystem = "s"\n'


@pytest.mark.parametrize("more", ["nope = 1", 'min_body_chars = "x"', 'system = "{title}"', 'forbid = ["("]', "out_dir = 3", "enabled = 1"])
def test_views_reject_what_they_do_not_know(tmp_path, more):
    key = more.split()[0]
    (tmp_path / "v.toml").write_text("\n".join(x for x in VIEW.split("\n") if not x.startswith(f"{key} ")) + more)
    with pytest.raises((views.ViewError, ValueError)):
        views.parse_views(tmp_path / "v.toml")
    assert views.output_dirs(tmp_path / "v.toml") == {}


def test_views(tmp_path):
    (tmp_path / "v.toml").write_text(VIEW + 'enabled = false\n[views.b]\nout_dir = "p"\nsystem = "s"\nmax_out_ratio = 2\n')
    got = views.parse_views(tmp_path / "v.toml")
    assert [v.name for v in got] == ["a", "b"] and got[1].max_out_ratio == 2.0
    assert [v.name for v in views.select_views(got)] == ["b"] and [v.name for v in views.select_views(got, ["b", "a"])] == ["a", "b"]
    with pytest.raises(views.ViewError):
        views.select_views(got, ["c"])


def test_pretrain_build(spark, tmp_path):
    for k in range(30):
        p = tmp_path / "in" / "A" / f"a{k:02d}.md"
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(f'---\ntitle: "T{k}"\n---\n\nBody {k}.\n')
    stats = pretrain.build(spark, str(tmp_path / "in"), str(tmp_path / "out"), "src", "L", "https://x/", budget=300)
    files = sorted(p.name for p in (tmp_path / "out").glob("*.parquet"))
    assert stats["rows"] == 30 and stats["files"] == len(files) > 1 and files[0] == f"src-00000-of-{len(files):05d}.parquet"
    ids = [r.doc_id for f in files for r in spark.read.parquet(str(tmp_path / "out" / f)).collect()]
    assert ids == sorted(ids)
    assert set(files) < set(sinks.write_checksums(spark, tmp_path / "out"))
    assert "SHA256SUMS" in sinks.check_publishable(tmp_path / "out")
    (tmp_path / "out" / "restricted").mkdir()
    with pytest.raises(PermissionError):
        sinks.check_publishable(tmp_path / "out")


def test_incremental_runs_do_new_work_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    run = lambda: incremental.run_once(incremental.first_of_key(incremental.new_records(spark, str(tmp_path / "in"), "q string, n int"), F.lower("q")), str(tmp_path / "out"), str(tmp_path / "cp"))
    sinks.append_json_lines(tmp_path / "in/a.json", [{"q": "One", "n": 1}, {"q": "two", "n": 2}])
    run()
    (tmp_path / "in/b.json").write_text(json.dumps({"q": "ONE", "n": 3}) + "\n" + json.dumps({"q": "three", "n": 4}) + '\n{"q": "to')
    run()
    run()
    assert sorted(r.q.lower() for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["one", "three", "two"]


def test_paraphrase(spark):
    body = "## One\n\nFirst here. Second here.\n\n| a | b |\n| 1 | 2 |\n\nThird here. Fourth here."
    got = rewrite.paraphrase(spark.createDataFrame([(1, body)], "id long, body string"), "id", "body", lambda: rewrite.local_rewriter).first()
    assert not got.rejected and got.degraded == 0 and "| a | b |\n| 1 | 2 |" in got.text and "Second here. First here." in got.text and got.text.startswith("## One")

    def failing():
        def ask(system, user, temperature):
            raise RuntimeError("down")

        return ask

    rows = rewrite.call_model(spark.createDataFrame([("x",)], "u string"), failing, "u", attempts=2, wait=0.0).first()
    assert rows.out is None and rows.error == "RuntimeError: down"


def test_answer_loop():
    said = iter([{"tool": "read", "arguments": {"t": "A"}}, {"tool": "none"}, {"tool": "read"}, {"answer": "yes"}])
    answer, messages = rewrite.answer_loop("q?", "seed", lambda m: next(said), {"read": lambda a: a["t"] * 9000})
    assert answer == "yes" and [m["role"] for m in messages] == ["user", "tool", "tool", "tool", "tool"] and len(messages[2]["content"]) == rewrite.TOOL_CHARS
    assert "failed" in messages[4]["content"]
