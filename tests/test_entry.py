"""The driver entry in copies of the repository that lack the optional parts."""

from __future__ import annotations

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).parent.parent
LIST = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


def _names(copy):
    done = subprocess.run([sys.executable, "-c", LIST], cwd=copy, capture_output=True, text=True)
    return done.returncode, done.stderr, [set(line.split()) for line in done.stdout.splitlines()]


@pytest.fixture
def copy(tmp_path):
    """The repository without ``llm``."""
    left_out = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(ROOT / "aislane", tmp_path / "aislane", ignore=left_out)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    return tmp_path


def test_without_the_training_data_part(copy):
    code, errors, (queries, sql) = _names(copy)
    assert code == 0, errors
    assert queries == sql and "slot_check" in queries and not any(n.startswith("op") or n == "pipeline" for n in queries)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    assert _names(copy)[2] == [queries, sql]


def test_errors_of_an_optional_part_are_not_hidden(copy):
    (copy / "corpus_pipeline.py").write_text("import no_such_module")
    code, errors, _ = _names(copy)
    assert code and "no_such_module" in errors
