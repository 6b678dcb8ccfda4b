import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parent.parent))
sys.path.insert(0, str(pathlib.Path(__file__).parent))

from compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(8)
    s.sparkContext.setLogLevel("OFF")
    s.conf.set("spark.sql.shuffle.partitions", "3")
    return s


@pytest.fixture(scope="session")
def rows(spark):
    """Build a frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema).coalesce(1)


def values(df, *cols):
    """Rows as a sorted list of tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])
