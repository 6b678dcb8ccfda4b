"""Every registered query gives the rows its SQL gives; the pair of environments shows every outcome."""

import pathlib

import pytest
from compare import compare, duck

from checks import CASES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(CASES))
def test_query_agrees_with_sql(spark, con, name):
    n, message = compare(spark, con, FOLDER, CASES[name])
    assert message == "" and n > 0


def test_every_outcome_occurs(spark):
    df = CASES["e2_seed_fill"].run(spark, FOLDER)
    assert {r["outcome"] for r in df.select("outcome").distinct().collect()} == {"kept", "created", "updated", "skipped"}


def test_entry(spark):
    import __spark_entry__ as entry

    assert {r["table_name"] for r in entry.entry(spark).collect()} == {"orders", "(total)"}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_a_left_over_folder_is_no_installation(tmp_path):
    """What is left of a deleted subpackage, a folder without sources, must not be imported."""
    import shutil
    import subprocess
    import sys

    root = pathlib.Path(__file__).parent.parent
    shutil.copytree(root / "checks", tmp_path / "checks")
    shutil.copytree(root / "tablesync", tmp_path / "tablesync", ignore=lambda d, names: ["llm"] if d.endswith("tablesync") else [])
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "tablesync/llm/__pycache__").mkdir(parents=True)
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()))"], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert said.stdout.strip() == str(len(CASES)), said.stderr
