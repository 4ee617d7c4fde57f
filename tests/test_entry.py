"""The entry must work where the text operators, their pipeline or both are not installed."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def names(folder):
    import json

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", SAY], cwd=folder, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return tuple(map(set, json.loads(done.stdout.splitlines()[-1])))


@pytest.mark.parametrize("without", ["llm", "llm and pipeline", "llm but for a cache"])
def test_entry_without_the_text_operators(tmp_path, without):
    shutil.copytree(os.path.join(ROOT, "tidegauge"), tmp_path / "tidegauge", ignore=shutil.ignore_patterns("__pycache__", "llm"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    pipeline = os.path.join(ROOT, "corpus_pipeline.py")
    if without != "llm and pipeline" and os.path.exists(pipeline):
        shutil.copy(pipeline, tmp_path)
    if without == "llm but for a cache":
        (tmp_path / "tidegauge" / "llm" / "__pycache__").mkdir(parents=True)
    found, sql = names(tmp_path)
    from tidegauge.plans.catalog import QUERIES
    from tidegauge.plans.oracles import ORACLES

    assert found == set(QUERIES) and len(found) >= 100
    assert sql == {n for n in QUERIES if n in ORACLES}
