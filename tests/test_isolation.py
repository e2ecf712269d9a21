"""The library stands without its optional parts: the training-data operators and their pipeline."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import __spark_entry__ as E
from tessera.session import local_session
spark = local_session(2)
names = set(E.queries())
assert names and not [n for n in names if n == "pipeline" or n.startswith("op")], names
assert set(E.oracle_sql()) <= names
assert E.entry(spark).count() == 1
assert E.queries()["latest_per_key"](spark, E.SMOKE_DIR).count() > 0
"""


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_the_operators(tmp_dir, with_pipeline):
    kept = f"{tmp_dir}/repo"
    shutil.copytree(f"{ROOT}/tessera", f"{kept}/tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", kept)
    if with_pipeline:
        shutil.copy(f"{ROOT}/corpus_pipeline.py", kept)
    env = {**os.environ, "PYTHONPATH": kept}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=kept, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_nothing_else_imports_the_operators():
    for folder, _, files in os.walk(f"{ROOT}/tessera"):
        if os.path.basename(folder) in ("llm", "__pycache__"):
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "tessera.llm" not in f.read(), name
