"""The library without the operators on training text."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

from reviewflow.plans.queries import QUERIES

ROOT = Path(__file__).resolve().parents[1]

PROBE = """
import __spark_entry__ as contract
assert set(contract.oracle_sql()) <= set(contract.queries())
print(*sorted(contract.queries()))
"""


def registered(folder: Path) -> list[str]:
    told = subprocess.run([sys.executable, "-c", PROBE], cwd=folder, capture_output=True, text=True, timeout=120)
    assert told.returncode == 0, told.stderr
    return told.stdout.split()


def test_the_rest_stands_alone(tmp_path):
    """With the folder `llm` gone the other queries are registered, whether the pipeline's file stays or not."""
    left_out = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(ROOT / "reviewflow", tmp_path / "reviewflow", ignore=left_out)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    assert registered(tmp_path) == sorted(QUERIES)
    (tmp_path / "corpus_pipeline.py").write_text("from reviewflow.llm import toxicity\n")
    assert registered(tmp_path) == sorted(QUERIES)
