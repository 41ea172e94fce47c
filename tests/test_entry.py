"""The driver contract on a copy of the repository without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT, SF_SMALL

SCRIPT = f"""
import __spark_entry__ as entry
names = set(entry.queries())
assert names and set(entry.oracle_sql()) <= names
assert not [n for n in names if n == "pipeline" or n.startswith("op")], names
from marketlake.session import get_session
spark = get_session("local[2]", shuffle_partitions=2)
print("rows", entry.queries()["benchmark_pivot"](spark, "{SF_SMALL}").count())
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_stands_without_the_subpackage(tmp_path, pipeline):
    copy = tmp_path / "repo"
    gone = {"llm", ".git", "__pycache__"} | (set() if pipeline else {"corpus_pipeline.py"})
    shutil.copytree(ROOT, copy, ignore=lambda _, names: gone & set(names))
    assert (copy / "corpus_pipeline.py").exists() == pipeline
    env = os.environ | {"PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    ran = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, env=env, text=True,
                         capture_output=True, timeout=300)
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert int(ran.stdout.split("rows")[1]) > 0
