"""The package without its optional part."""

from __future__ import annotations

import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT

SCRIPT = """
import __spark_entry__ as e
from checks import oracle
from checks.registry import registered
assert set(e.queries()) == set(registered()) and set(e.oracle_sql()) == set(oracle.statements())
"""


@pytest.mark.parametrize("gone", [("llm", "corpus_pipeline.py"), ("llm",)])
def test_entry_without_the_optional_part(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", *gone))
    subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, check=True, timeout=120)
