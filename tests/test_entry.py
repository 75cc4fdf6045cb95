"""The entry file works without the optional subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_data_subpackage(tmp_path):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py", "*.md", "*.json")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "assert set(q) == set(o) and len(q) > 40, len(q); assert not any(n.startswith('op') or n == 'pipeline' for n in q)")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
