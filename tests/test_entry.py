"""The entry module without the corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path


def test_entry_imports_without_the_corpus_operators(tmp_path):
    root = Path(__file__).resolve().parents[1]
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "fragloom", tmp_path / "fragloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(n.startswith('op') for n in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
