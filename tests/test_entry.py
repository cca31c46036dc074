"""The driver's entry works without the training-data operators or what they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys
sys.modules[{name!r}] = None  # importing it fails
import __spark_entry__ as entry
from tripweave.queries import QUERIES
assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) <= set(QUERIES)
"""


@pytest.mark.parametrize("name", ["tripweave.llm", "corpus_pipeline", "ahocorasick", "public_tokenizers"])
def test_entry_without_a_part(name):
    run = subprocess.run([sys.executable, "-c", CODE.format(name=name)], cwd=ROOT, capture_output=True)
    assert run.returncode == 0, run.stderr.decode()
