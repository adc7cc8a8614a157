"""The entry point gives its own queries also where the corpus operators cannot be imported."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDE = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hide())
sys.path.insert(0, {repo!r})
import __spark_entry__ as e
q = e.queries()
print(len(q), sum(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in q), len(e.oracle_sql()))
"""


def entry(name):
    return subprocess.run([sys.executable, "-B", "-c", HIDE.format(name=name, repo=REPO)], capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("name", ["zstandard", "public_tokenizers", "corpus_pipeline", "alignfold.llm"])
def test_queries_without_a_module_of_the_corpus_operators(name):
    got = entry(name)
    assert got.returncode == 0, got.stderr
    total, corpus, oracles = map(int, got.stdout.split())
    assert total >= 112 and corpus == 0 and oracles >= 112


def test_a_fault_of_the_library_is_an_error():
    assert "alignfold.functions.text" in entry("alignfold.functions.text").stderr
