import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_works_without_the_corpus_operators():
    code = "import sys; sys.modules['linkloom.llm'] = None; import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), any(n.startswith('op') for n in q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 40 and out[1] == "False"


def test_nothing_else_imports_them():
    for path in (ROOT / "linkloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(encoding="utf-8"), path
