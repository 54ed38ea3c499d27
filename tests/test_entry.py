"""The entry module without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_the_rest_stands_without_the_training_data_folders(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if with_pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=left_out)
    look = "import __spark_entry__ as e; print(sorted(set(e.queries()) ^ set(e.oracle_sql())), len(e.queries()) > 90)"
    seen = subprocess.run([sys.executable, "-c", look], cwd=copy, capture_output=True, text=True)
    assert seen.stdout.split() == ["[]", "True"], seen.stderr
    run = [sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "tests"]
    found = subprocess.run(run, cwd=copy, capture_output=True, text=True)
    assert found.returncode == 0, found.stdout
