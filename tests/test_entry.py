"""The entry module with and without its optional part, in processes of their own."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.fixture
def copy(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", tmp_path)
    shutil.copytree(f"{ROOT}/quire", tmp_path / "quire", ignore=shutil.ignore_patterns("__pycache__"))
    return tmp_path


def run(folder, before=""):
    return subprocess.run([sys.executable, "-c", before + SHOW], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})


def test_without_the_corpus_part(copy):
    shutil.rmtree(copy / "quire/llm", ignore_errors=True)
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    done = run(copy)
    assert done.returncode == 0 and done.stdout.split()[2] == "False" and int(done.stdout.split()[1]) > 50, done.stderr


@pytest.mark.skipif(not os.path.exists(f"{ROOT}/quire/llm/__init__.py"), reason="the corpus part is absent")
def test_missing_libraries_and_own_faults(copy):
    assert run(copy).stdout.split()[2] == "True"
    done = run(copy, "import sys; sys.modules['ahocorasick'] = None; ")
    assert done.returncode == 0 and done.stdout.split()[2] == "False" and "ahocorasick" in done.stderr
    (copy / "quire/llm/broken.py").write_text("import quire.llm.nothing_here\n")
    with open(copy / "quire/llm/queries.py", "a") as f:
        f.write("import quire.llm.broken\n")
    done = run(copy)
    assert done.returncode != 0 and "nothing_here" in done.stderr
