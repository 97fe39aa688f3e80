import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tidewake.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tidewake-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def fx(spark):
    from checks.fixtures import Fixtures

    return Fixtures(spark, SMALL)


@pytest.fixture
def same():
    """Compare two DataFrames as multisets of rows."""
    def check(left, right):
        columns = sorted(left.columns)
        assert columns == sorted(right.columns)
        rows = [sorted(repr(tuple(r)) for r in df.select(*columns).collect()) for df in (left, right)]
        assert rows[0] == rows[1]
        return len(rows[0])

    return check
