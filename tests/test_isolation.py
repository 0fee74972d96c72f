"""The library stands without the training-data subpackage."""

import ast
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_nothing_else_imports_llm():
    for p in (ROOT / "tidemark").rglob("*.py"):
        if "llm" in p.parts:
            continue
        for node in ast.walk(ast.parse(p.read_text())):
            names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
            assert not any(n.startswith("tidemark.llm") or n == "corpus_pipeline" for n in names), p


def test_entry_imports_without_it(tmp_path):
    import shutil

    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
