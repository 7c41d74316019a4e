"""The registered queries against their SQL, on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    fix = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(fix(r[k]) for k in order) for r in rows), key=str)


@needs_data
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = db.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.fetchall())


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_everything_else_works_without_the_training_operators(tmp_path):
    """In a copy without the folders of the training-data operators and the pipeline."""
    root = Path(__file__).parent.parent
    skip = lambda folder, names: [n for n in names if n in ("llm", "corpus_pipeline.py", ".git", "__pycache__")]
    shutil.copytree(root, tmp_path / "copy", ignore=skip)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 30 and not any(n.startswith(('op', 'pipe')) for n in e.queries())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=env, check=True)
    # A part that is there but doesn't load isn't taken for absent.
    (tmp_path / "copy" / "docloom" / "llm").mkdir()
    (tmp_path / "copy" / "docloom" / "llm" / "__init__.py").touch()
    (tmp_path / "copy" / "docloom" / "llm" / "queries.py").write_text("import a_module_that_no_one_has")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", env=env, capture_output=True, text=True)
    assert done.returncode and "a_module_that_no_one_has" in done.stderr
