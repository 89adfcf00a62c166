"""The contract module without the corpus folders."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(folder):
    code = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(*e.queries())"
    return set(subprocess.run([sys.executable, "-c", code], cwd=folder, check=True, capture_output=True, text=True).stdout.split())


def copied(tmp_path, *left_out):
    skip = shutil.ignore_patterns("__pycache__", ".git", "tests", *left_out)
    return shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)


def test_without_corpus_package(tmp_path):
    found = names(copied(tmp_path, "llm"))  # corpus_pipeline.py is still there
    assert "forecast_fill" in found and "pipeline" not in found


def test_without_corpus_package_and_pipeline(tmp_path):
    assert names(copied(tmp_path, "llm", "corpus_pipeline.py")) == names_of_warehouse()


def names_of_warehouse():
    from checks import QUERIES

    return set(QUERIES)
