from __future__ import annotations

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def test_names_agree():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_stands_without_the_optional_package():
    code = "import sys; sys.modules['pagelode.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert q and not any(x.startswith('p') and x[1].isdigit() for x in q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=REPO)


def test_nothing_else_imports_the_optional_package():
    for path in (REPO / "pagelode").rglob("*.py"):
        if "llm" not in path.parts:
            assert "pagelode.llm" not in path.read_text(), path
