"""The entry module without the libraries that only the add-on needs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.modules[{library!r}] = None
import __spark_entry__ as contract
names = set(contract.queries())
assert "feature_mart" in names and set(contract.oracle_sql()) <= names, names
assert not any(name.startswith("op1") or name == "pipeline" for name in names), names
"""


@pytest.mark.parametrize("library", ["zstandard", "public_tokenizers", "civicmart.llm", "corpus_pipeline"])
def test_other_queries_are_registered_without_the_add_on(library):
    run = subprocess.run([sys.executable, "-c", CODE.format(library=library)], cwd=ROOT, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
