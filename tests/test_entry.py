"""The entry without the subpackage for training data, or without a library that only it needs."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

_BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {0!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any(n.startswith("op") for n in entry.queries()), "pipeline" in entry.queries())
"""


def _run(name: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", _BLOCKED.format(name)], cwd=ROOT, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("name", ["textloom.llm", "corpus_pipeline", "xxhash", "public_tokenizers"])
def test_the_other_queries_stay(name):
    queries, checks, operators, pipeline = _run(name).stdout.split()
    assert int(queries) > 100 and int(checks) > 90 and (operators, pipeline) == ("False", "False")


def test_a_broken_import_is_raised():
    broken = _run("textloom.operators.frames")
    assert broken.returncode and "textloom.operators.frames" in broken.stderr
