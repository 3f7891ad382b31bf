"""The entry module without the corpus subpackage."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_the_corpus_subpackage(tmp_path):
    shutil.copytree(ROOT / "tilewright", tmp_path / "tilewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "tilewright/llm/__pycache__").mkdir(parents=True)  # an emptied folder is no subpackage
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
