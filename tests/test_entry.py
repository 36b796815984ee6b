"""The driver contract, with and without the corpus subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = """
import __spark_entry__ as e
q, o = e.queries(), e.oracle_sql()
assert not [n for n in q if n.startswith("op") and n[2:3].isdigit()] and "pipeline" not in q, sorted(q)
assert set(o) <= set(q)
print(len(q))
"""


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()


@pytest.mark.parametrize("pipeline", [True, False])
def test_queries_without_the_corpus_subpackage(tmp_path, pipeline):
    """A copy of the tree without the subpackage, with or without the pipeline file, lists all other queries."""
    shutil.copytree(os.path.join(REPO, "reviewlake"), tmp_path / "reviewlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py") if pipeline else ("__spark_entry__.py",):
        if os.path.exists(os.path.join(REPO, name)):
            shutil.copy(os.path.join(REPO, name), tmp_path)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    from reviewlake.plans import registry
    assert int(done.stdout) == len(registry.queries()) >= 106
