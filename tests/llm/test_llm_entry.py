"""The entry module with the text operators: a wrong import inside is raised, a missing library is not."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
COUNT = "import __spark_entry__ as e; q = e.queries(); print('op13_toxicity' in q, 'pipeline' in q, 'talent_match' in q)"


def run(folder, code):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=120)


def copy(tmp_path):
    shutil.copytree(os.path.join(REPO, "traitmatch"), tmp_path / "traitmatch", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(os.path.join(REPO, name), tmp_path)
    return tmp_path


def test_all_queries_are_registered_and_a_missing_library_leaves_them_out(tmp_path):
    folder = copy(tmp_path)
    assert run(folder, COUNT).stdout.split() == ["True", "True", "True"]
    hidden = run(folder, "import sys; sys.modules['xxhash'] = None; " + COUNT)
    assert hidden.stdout.split() == ["False", "False", "True"] and "xxhash" in hidden.stderr
    os.remove(folder / "corpus_pipeline.py")
    assert run(folder, COUNT).stdout.split() == ["True", "False", "True"]


def test_a_wrong_import_inside_is_raised(tmp_path):
    folder = copy(tmp_path)
    with open(folder / "traitmatch" / "llm" / "queries.py", "a") as f:
        f.write("\nfrom traitmatch.llm.bpe import no_such_name\n")
    out = run(folder, COUNT)
    assert out.returncode != 0 and "no_such_name" in out.stderr
    with open(folder / "traitmatch" / "llm" / "queries.py", "a") as f:
        f.write("\nfrom traitmatch.llm.no_such_module import x\n")
    assert run(folder, COUNT).returncode != 0
