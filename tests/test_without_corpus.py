"""The library without the corpus operators and without their pipeline."""

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
assert names == set(contract.oracle_sql()) and len(names) > 90, names
assert not any(n.startswith("op") or n == "pipeline" for n in names)
"""


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_the_rest_stands_alone(tmp_path, with_pipeline):
    """The other queries import when the folders are gone, whether the pipeline file is there or not."""
    skipped = shutil.ignore_patterns("llm", ".*", "__pycache__", "*.json", "*.txt", "*.md")
    shutil.copytree(ROOT / "obslake", tmp_path / "obslake", ignore=skipped)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if with_pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    done = subprocess.run([sys.executable, "-c", PROBE], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
