"""The entry without the removable subpackage, or without a library of it."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), e.llm is None)"


def count(folder, **env):
    ran = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, env=os.environ | env, capture_output=True, text=True)
    assert ran.returncode == 0, ran.stderr
    return ran.stdout.split()[-3:]


@pytest.fixture
def copy(folder):
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "earshot"):
        if not (ROOT / name).exists():
            continue
        if name == "earshot":
            shutil.copytree(ROOT / name, Path(folder) / name, ignore=shutil.ignore_patterns("__pycache__"))
        else:
            shutil.copy(ROOT / name, folder)
    return folder


def test_sources_gone_but_caches_left(copy):
    for left in Path(copy, "earshot", "llm").glob("*.py"):
        left.unlink()
    Path(copy, "earshot", "llm", "__pycache__").mkdir(parents=True, exist_ok=True)
    found = count(copy)
    assert found[0] == found[1] and int(found[0]) > 60 and found[2] == "True"


def test_a_library_of_the_subpackage_is_missing(copy):
    for name in ("tiktoken", "xxhash"):
        Path(copy, f"{name}.py").write_text("raise ImportError('not here')\n")
    found = count(copy, PYTHONPATH=str(copy))
    assert found[0] == found[1] and found[2] == "True"
