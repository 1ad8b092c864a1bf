"""The driver contract without the optional corpus operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_corpus_operators(tmp_path):
    shutil.copytree(f"{ROOT}/cohortweave", tmp_path / "cohortweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), any(n.startswith('op1') for n in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    count, *others = done.stdout.split()
    assert int(count) >= 82 and others == ["False", "False"]
