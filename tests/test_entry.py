"""The registered queries without what is optional."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract

ROOT = Path(contract.__file__).parent
BLOCKED = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] == {name!r} or name == {name!r}:
            raise {error}(f"no {{name}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as contract
print(len(contract.queries()), len(contract.oracle_sql()))
"""


@pytest.mark.parametrize("name", ["cartlayers.llm", "corpus_pipeline", "public_tokenizers", "numpy"])
@pytest.mark.parametrize("error", ["ModuleNotFoundError", "ImportError"])
def test_own_queries_remain_without_optional_modules(name, error):
    code = BLOCKED.format(name=name, error=error)
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    own = str(len(contract.OWN_QUERIES))
    assert done.stdout.split() == [own, own], done.stderr
