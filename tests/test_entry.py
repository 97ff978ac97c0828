"""The entry module with and without the llm folders."""

import subprocess
import sys

import __spark_entry__

WITHOUT = """
import sys
sys.modules["corpus_pipeline"] = None
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "palimpsest.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.modules.pop("corpus_pipeline")
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(len(e.queries()), any(k.startswith("op") for k in e.queries()), set(e.oracle_sql()) <= set(e.queries()))
"""


def test_it_stands_without_the_subpackage():
    said = subprocess.run([sys.executable, "-c", WITHOUT], capture_output=True, text=True, timeout=120, cwd=__spark_entry__.__file__.rpartition("/")[0])
    n, any_op, known = said.stdout.split()
    assert int(n) > 50 and any_op == "False" and known == "True"


def test_sql_only_for_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
