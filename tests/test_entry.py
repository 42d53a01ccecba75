"""The entry works without the optional package, also if compiled files of it were left behind."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(folder) -> list[str]:
    code = "import __spark_entry__ as e; print(' '.join(sorted(e.queries()))); assert set(e.oracle_sql()) <= set(e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("left", ["nothing", "compiled files", "compiled files and the pipeline", "the pipeline"])
def test_entry_without_the_optional_package(tmp_path, left):
    shutil.copytree(f"{ROOT}/tidemill", tmp_path / "tidemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    if "compiled" in left:
        (tmp_path / "tidemill/llm/__pycache__").mkdir(parents=True)
        (tmp_path / "tidemill/llm/__pycache__/queries.cpython-313.pyc").write_bytes(b"")
    if "pipeline" in left:
        # What the top of the pipeline does.
        (tmp_path / "corpus_pipeline.py").write_text("from tidemill.llm import line_dedup\nrun = ORACLE_SQL = None\n")
    found = names(tmp_path)
    assert "scan_flags" in found
    assert not [n for n in found if n.startswith("op") or n == "pipeline"]


def test_other_import_errors_are_not_swallowed(tmp_path):
    shutil.copytree(f"{ROOT}/tidemill", tmp_path / "tidemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    with pytest.raises(AssertionError, match="no_such_module"):
        names(tmp_path)
