"""The entry module with and without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def keys(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    run = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
    return run, [set(line.split()) for line in run.stdout.strip().split("\n")] if run.returncode == 0 else None


@pytest.fixture
def copy(tmp_path):
    to = tmp_path / "repo"
    shutil.copytree(REPO, to, ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__", "tests", ".pytest_cache")
                                                       or n == "llm" and os.path.basename(d) == "spendlens" or n == "corpus_pipeline.py"])
    return to


@pytest.mark.parametrize("left", ["gone", "empty", "caches", "pipeline only"])
def test_without_the_optional_parts(copy, left):
    llm = copy / "spendlens" / "llm"
    if left in ("empty", "caches"):
        llm.mkdir()
    if left == "caches":
        (llm / "__pycache__").mkdir()
        (llm / "__pycache__" / "queries.cpython-313.pyc").write_bytes(b"")
    if left == "pipeline only":
        (copy / "corpus_pipeline.py").write_text("from spendlens.llm.common import stored\n")
    run, found = keys(copy)
    assert found is not None, run.stderr
    from spendlens.plans import registry

    assert found[0] == found[1] == set(registry.queries())


def test_an_error_inside_the_optional_parts_shows(copy):
    llm = copy / "spendlens" / "llm"
    llm.mkdir()
    (llm / "__init__.py").write_text("")
    (llm / "queries.py").write_text("import spendlens.llm.missing_part\n")
    run, found = keys(copy)
    assert found is None and "missing_part" in run.stderr
