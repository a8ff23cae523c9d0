"""The entry point with and without the optional modules."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
PROBE = """
import __spark_entry__ as e
from checks.oracles import ORACLES
from checks.queries import QUERIES
assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(ORACLES), sorted(e.queries())
"""


@pytest.mark.parametrize("without", [("sentiflow/llm", "tests/llm"), ("sentiflow/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_the_optional_modules(tmp_path, without):
    def left_out(folder, names):
        inside = os.path.relpath(folder, REPO)
        return [n for n in names if n in (".git", "__pycache__") or os.path.normpath(f"{inside}/{n}") in without]

    shutil.copytree(REPO, tmp_path / "repo", ignore=left_out)
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path / "repo", env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
