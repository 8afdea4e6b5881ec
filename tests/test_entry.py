"""The entry module without its optional part, and how the package reaches workers."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from wellfield import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
names = entry.queries()
print(len(names), sum(n.startswith("op") for n in names), "pipeline" in names, sorted(entry.MISSING), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["regex", "public_tokenizers", "wellfield.llm", "corpus_pipeline"])
def test_other_queries_stay(name):
    """Whatever the optional part lacks, the queries on wells are there."""
    run = subprocess.run([sys.executable, "-c", HIDE.format(name=name)], cwd=ROOT, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ROOT})
    assert run.returncode == 0, run.stderr
    count, ops, pipeline, *_ = run.stdout.strip().splitlines()[-1].split()
    assert int(count) >= 190
    assert int(ops) == 0 or name == "corpus_pipeline"
    assert pipeline == "False" or name == "regex"


@pytest.mark.parametrize("master, sent", [("local[4]", 0), ("local", 0), ("local-cluster[2,1,1024]", 1), ("spark://host:7077", 1), ("yarn", 1)])
def test_the_package_is_sent_to_clusters(monkeypatch, master, sent):
    monkeypatch.chdir(ROOT)
    files = []
    context = SimpleNamespace(master=master, addPyFile=files.append)
    for _ in range(2):
        session.ship(SimpleNamespace(sparkContext=context))
    assert len(files) == sent
