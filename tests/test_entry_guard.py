"""The entry module without the corpus operators or a module that only they need."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["countpanel.llm", "public_tokenizers", "xxhash", "regex", "corpus_pipeline"])
def test_entry_without(missing):
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {missing!r} or name.startswith({missing!r}):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Gone())
sys.path.insert(0, {REPO!r})
import __spark_entry__ as e
names = e.queries()
print("N", len(names), any(n.startswith("op") for n in names), set(e.oracle_sql()) <= set(names))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True, cwd="/")
    n, corpus, ok = done.stdout.split()[1:]
    assert int(n) > 200 and corpus == "False" and ok == "True" and "left out" in done.stderr


def test_faults_of_the_library_are_not_swallowed():
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "countpanel.operators.windows":
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Gone())
sys.path.insert(0, {REPO!r})
import __spark_entry__
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd="/")
    assert done.returncode and "countpanel.operators.windows" in done.stderr
