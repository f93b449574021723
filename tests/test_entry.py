"""The entry point with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left", [None, "cofre/llm/__pycache__"])
def test_entry_without_the_training_data_operators(tmp_path, left):
    """Also when an empty folder is left of them."""
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/cofre", tmp_path / "cofre", ignore=lambda _, names: [n for n in names if n in ("llm", "__pycache__")])
    if left:
        os.makedirs(tmp_path / left)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.queries()) == sorted(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert found.returncode == 0, found.stderr
    n, complete, any_op = found.stdout.split()[-3:]
    assert int(n) > 80 and complete == "True" and any_op == "False"
