"""Every registered query of the subpackage beside its SQL."""

import pytest
from compare import compare, duck

from tablesync.llm.queries import CASES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(CASES))
def test_query(spark, con, name):
    n, message = compare(spark, con, FOLDER, CASES[name])
    assert not message and n > 0


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in CASES) == list(range(1, 14))
