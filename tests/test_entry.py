"""The driver's contract, with and without the corpus subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_runs(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["source1_entity_id", "matched_entity_ids"] and df.count() == 150


def test_every_oracle_has_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_imports_without_the_corpus_operators(tmp_path):
    for name in ("linkloom", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "linkloom" / "llm", ignore_errors=True)
    shutil.copytree(ROOT / "tests", tmp_path / "tests")
    shutil.rmtree(tmp_path / "tests" / "llm", ignore_errors=True)
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert collected.returncode == 0, collected.stdout[-2000:]
    assert not [p for p in (tmp_path / "linkloom").rglob("*.py") if "llm" in p.read_text()]
    code = "import __spark_entry__ as e; q = e.queries(); assert 'matching_output' in q and 'pipeline' not in q and not [x for x in q if x.startswith('op')]; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
