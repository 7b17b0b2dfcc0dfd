"""The entry works with and without the text subpackage, and hides no other import error."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


def imported(folder):
    return subprocess.run([sys.executable, "-B", "-c", NAMES], cwd=folder, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(folder)})


@pytest.fixture
def copy(tmp_path):
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{REPO}/canopy", tmp_path / "canopy", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    return tmp_path


def test_without_the_subpackage(copy):
    out = imported(copy)
    assert out.returncode == 0, out.stderr
    names = out.stdout.split()
    assert "id3_tree" in names and not any(n.startswith("op1_") or n == "pipeline" for n in names)
    (copy / "corpus_pipeline.py").write_text("import canopy.llm.common\n")
    assert "pipeline" not in imported(copy).stdout.split()


def test_errors_inside_the_subpackage_are_raised(copy):
    (copy / "canopy" / "llm").mkdir()
    (copy / "canopy" / "llm" / "__init__.py").write_text("")
    (copy / "canopy" / "llm" / "queries.py").write_text("import a_module_that_is_not_there\n")
    out = imported(copy)
    assert out.returncode != 0 and "a_module_that_is_not_there" in out.stderr
