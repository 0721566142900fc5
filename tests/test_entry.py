"""The entry module with, without and with a broken training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(*sorted(e.queries()))"


def _copy(to, llm):
    os.makedirs(f"{to}/repo")
    for name in ("strata", "fixtures"):
        shutil.copytree(f"{ROOT}/{name}", f"{to}/repo/{name}",
                        ignore=shutil.ignore_patterns("__pycache__", *([] if llm else ["llm"])))
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * llm:
        shutil.copy(f"{ROOT}/{name}", f"{to}/repo")
    return f"{to}/repo"


def _run(repo):
    return subprocess.run([sys.executable, "-B", "-c", SHOW], cwd=repo, capture_output=True,
                          text=True, env={**os.environ, "PYTHONPATH": repo})


def test_entry_without_the_subpackage(workdir):
    repo = _copy(workdir, False)
    done = _run(repo)
    assert done.returncode == 0, done.stderr
    names = done.stdout.split()
    assert "fact_sales" in names and not [n for n in names if n.startswith("op") or n == "pipeline"]
    os.makedirs(f"{repo}/strata/llm/__pycache__")       # what a deletion may leave
    assert _run(repo).stdout.split() == names


def test_a_broken_subpackage_is_not_hidden(workdir):
    if not os.path.exists(f"{ROOT}/corpus_pipeline.py"):
        pytest.skip("no training-data subpackage")
    repo = _copy(workdir, True)
    assert "pipeline" in _run(repo).stdout.split()
    with open(f"{repo}/strata/llm/queries.py", "a") as f:
        f.write("\nimport no_such_module\n")
    done = _run(repo)
    assert done.returncode and "no_such_module" in done.stderr
