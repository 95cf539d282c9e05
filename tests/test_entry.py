"""The entry without the training-data package."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

WITHOUT = """
import sys
sys.modules["corpus_pipeline"] = None
import __spark_entry__ as entry
assert entry.queries() == entry.own_queries()
assert set(entry.queries()) <= set(entry.oracle_sql())
"""


def test_entry_without_the_package():
    subprocess.run([sys.executable, "-c", WITHOUT], check=True, cwd=Path(__file__).parent.parent)


def test_the_library_does_not_import_the_package():
    code = "import sys, clickpath, clickpath.__main__; assert not [m for m in sys.modules if m.startswith('clickpath.llm')]"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parent.parent)
