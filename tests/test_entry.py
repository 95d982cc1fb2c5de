"""The driver's contract, also without the llm subpackage."""

from __future__ import annotations

import os
import subprocess
import sys

import __spark_entry__ as entry

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_names():
    q = entry.queries()
    assert set(entry.oracle_sql()) <= set(q) and all(callable(f) for f in q.values())
    assert {"p1_found", "p2_found", "p5_found", "p7_found"} <= set(q)


def test_without_llm():
    code = "import sys; sys.modules['chartweave.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p1_found' in q and 'p8_ids' not in q; e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, timeout=120).returncode == 0


def test_nothing_imports_llm():
    for folder, _, names in os.walk(os.path.join(REPO, "chartweave")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    assert "chartweave.llm" not in open(os.path.join(folder, n)).read(), n


def test_entry(spark):
    assert entry.entry(spark).count() > 0
