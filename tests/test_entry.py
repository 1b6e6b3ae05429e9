"""The entry with and without the corpus subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; print(sum(n.startswith('op') or n == 'pipeline' for n in e.queries()), len(e.queries()) > 80, {*e.oracle_sql()} <= {*e.queries()})"


def ask(folder):
    return subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, timeout=120)


def test_entry_works_without_the_subpackage(tmp_path):
    keep = shutil.ignore_patterns("__pycache__", ".git", "tests", "llm", "corpus_pipeline.py")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=keep)
    assert ask(tmp_path / "repo").stdout.split() == ["0", "True", "True"]
    # what is there but broken isn't hidden
    (tmp_path / "repo" / "linkforge" / "llm").mkdir()
    (tmp_path / "repo" / "linkforge" / "llm" / "__init__.py").write_text("import no_such_module_at_all\n")
    (tmp_path / "repo" / "corpus_pipeline.py").write_text("import linkforge.llm\n")
    assert "no_such_module_at_all" in ask(tmp_path / "repo").stderr
