"""The entry point with and without the folders of the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("removed", [[], ["tripledger/llm", "tests/llm", "corpus_pipeline.py"], ["tripledger/llm", "tests/llm"]])
def test_queries_of_a_copy(tmp_path, removed):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse", ".hypothesis")
    shutil.copytree(ROOT, copy, ignore=left_out)
    for name in removed:
        path = copy / name
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), 'recon_gaps' in q, 'pipeline' in q, set(o) <= set(q))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr[-2000:]
    there = (ROOT / "tripledger/llm/__init__.py").exists() and not removed
    assert ran.stdout.split()[1:] == ["True", str(there), "True"] and int(ran.stdout.split()[0]) > 150
