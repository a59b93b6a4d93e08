"""Without the training-data part everything else still imports and is registered."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_data_part(tmp_path):
    for name in ("__spark_entry__.py", "bench.py"):
        shutil.copy(f"{REPO}/{name}", tmp_path)
    shutil.copytree(f"{REPO}/tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); assert len(q) > 70 and set(o) <= set(q) and 'pipeline' not in q"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
