"""The entry module with and without the operators for training data."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import importlib.abc, sys
class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if any((name + ".").startswith(h + ".") for h in sys.argv[1].split(",")):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry, catalog
found = entry.queries()
assert {n for n in found if not n.startswith("op") and n != "pipeline"} <= set(catalog.QUERIES)
assert set(catalog.QUERIES) <= set(found) and set(entry.oracle_sql()) <= set(found)
print(len(set(found) - set(catalog.QUERIES)))
"""


@pytest.mark.parametrize("hidden", ["newslens.llm", "newslens.llm,corpus_pipeline"])
def test_entry_without_the_subpackage(hidden):
    run = subprocess.run([sys.executable, "-c", SCRIPT, hidden], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.strip() == "0"


def test_a_fault_inside_the_subpackage_is_not_hidden():
    run = subprocess.run([sys.executable, "-c", SCRIPT, "newslens.plans.ordered"], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert run.returncode and "newslens.plans.ordered" in run.stderr
