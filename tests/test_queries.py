"""Every query of the core against its SQL on the smallest test tables."""

import os
import shutil
import subprocess
import sys

import pytest

from tessera.plans import catalogue
from tests.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", catalogue.queries())
def test_query(spark, con, name):
    assert compare(spark, con, name, FOLDER, catalogue.queries()[name], catalogue.oracle_sql().get(name)) == ""


def test_entry_survives_without_the_subpackage(tmp_path):
    """In a copy without the folder, every query of the core is there, and no other."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/tessera", tmp_path / "tessera", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": ""})
    names, sqls = (line.split() for line in said.stdout.splitlines())
    assert names == sorted(catalogue.queries()) and set(sqls) <= set(names)
