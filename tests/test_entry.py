"""The driver's entry points without the optional packages."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as e
assert e.queries().keys() == e.order_queries().keys() == e.oracle_sql().keys()
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_works_alone(tmp_path, pipeline):
    """As when the folders of the training-data operators are deleted, with the pipeline or without."""
    for name in ("__spark_entry__.py", "oracle_queries.py", *["corpus_pipeline.py"] * pipeline):
        shutil.copy(REPO / name, tmp_path)
    shutil.copytree(REPO / "ordermill", tmp_path / "ordermill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    alone = os.environ | {"PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=alone, check=True, timeout=120)


def test_nothing_else_imports_the_optional_package():
    others = [p for p in (REPO / "ordermill").rglob("*.py") if "llm" not in p.relative_to(REPO).parts]
    assert others and not any("ordermill.llm" in p.read_text() for p in others)
