import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).parent.parent


@pytest.mark.parametrize("pipeline", [False, True])
def test_the_library_works_without_its_optional_part(tmp_path, pipeline):
    """The folders of the optional part are gone; the pipeline's module at the top either stays or goes."""
    shutil.copytree(REPO / "tarmac", tmp_path / "tarmac", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    if pipeline and (REPO / "corpus_pipeline.py").exists():
        shutil.copy(REPO / "corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'month_axis' in q and not any(n.startswith('op') or n == 'pipeline' for n in q) and set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
