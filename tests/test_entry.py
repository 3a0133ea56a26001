"""The entry module without the optional text operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op1') for k in e.queries()))"


def copy(tmp_path):
    """The package and the entry module alone."""
    shutil.copytree(os.path.join(REPO, "traitmatch"), tmp_path / "traitmatch", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), tmp_path)
    return tmp_path


def run(folder, code):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=120)


def test_entry_works_without_the_text_operators(tmp_path):
    out = run(copy(tmp_path), COUNT)
    assert out.returncode == 0, out.stderr
    queries, sql, text = out.stdout.split()
    assert queries == sql and int(queries) >= 85 and text == "False"
