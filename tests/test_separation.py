"""The rest of the repository works without the optional subpackage, with or without the pipeline's file."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
PROBE = """
import __spark_entry__ as contract
names = set(contract.queries())
assert names and not any(n.startswith("op") and n[2:3].isdigit() for n in names) and "pipeline" not in names
assert names == set(contract.oracle_sql())
print(len(names))
"""


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_imports_without_the_operators(tmp_path, left_out):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *left_out))
    assert not (copy / "driftline" / "llm").exists() and not (copy / "tests" / "llm").exists()
    run = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr


def test_nothing_else_imports_the_operators():
    for file in (ROOT / "driftline").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert "driftline.llm" not in file.read_text()
