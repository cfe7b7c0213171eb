import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)


def test_sql_is_of_registered_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_works_without_the_training_data_operators():
    code = (
        "import sys; sys.modules['textloom.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
        "assert 'search_text_topk' in e.queries() and not any(k.startswith('op') for k in e.queries()) and 'pipeline' not in e.queries(); assert e.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_them():
    for p in [*ROOT.glob("textloom/**/*.py")]:
        if "llm" not in p.relative_to(ROOT).parts:
            assert "textloom.llm" not in p.read_text(), p
