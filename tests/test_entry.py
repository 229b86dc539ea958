"""The entry works without the corpus operators, however they are missing."""

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import json, sys
for name in sys.argv[1:]:
    sys.modules[name] = None  # importing it raises ImportError
import __spark_entry__ as e
print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))
"""


def names(root: Path, *blocked: str) -> list[list[str]]:
    found = subprocess.run([sys.executable, "-c", CODE, *blocked], cwd=root, env=os.environ | {"PYTHONPATH": str(root)}, capture_output=True, text=True, timeout=120)
    assert not found.returncode, found.stderr
    return json.loads(found.stdout)


def core() -> list[list[str]]:
    from brinefold.plans import catalogue

    return [sorted(catalogue.QUERIES), sorted(catalogue.ORACLE_SQL)]


def test_without_the_folders(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse"))
    assert names(tmp_path / "repo") == core()


@pytest.mark.parametrize("module", ["xxhash", "regex", "brinefold.llm"])
def test_without_a_dependency(module):
    assert names(ROOT, module) == core()
