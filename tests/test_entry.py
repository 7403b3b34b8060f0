"""The monitor's queries are offered whether or not the optional operators can be imported."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as entry
assert set(entry.queries()) == set(entry.CORE) and set(entry.oracle_sql()) <= set(entry.CORE)
assert len(entry.CORE) > 80
"""


@pytest.mark.parametrize("blocked", ["ahocorasick", "xxhash", "zstandard", "public_tokenizers", "tidewatch.llm", "corpus_pipeline"])
def test_entry_without_an_optional_package(blocked):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
