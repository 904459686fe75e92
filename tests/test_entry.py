"""The driver contract holds without the training-data operators and their libraries."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from fleetlake.checks import queries

ROOT = str(Path(__file__).resolve().parents[1])


@pytest.mark.parametrize("missing", ["xxhash", "regex", "fleetlake.llm", "corpus_pipeline"])
def test_entry_imports_without(missing):
    script = f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules[{missing!r}] = None\n"
    script += "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=120)
    n = len(queries.queries())
    assert done.stdout.split() == [str(n), str(n)], done.stderr[-2000:]
