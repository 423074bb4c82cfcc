import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="8g",
        spark__sql__maxMetadataStringLength="2000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def wh(spark, tmp_path):
    from millrace.plans.warehouse import Warehouse

    return Warehouse(spark, str(tmp_path / "warehouse"))


SF = "/root/testdata/sf0.001"


@pytest.fixture
def sf():
    return SF


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def plan(df):
    """The physical plan; the final one if the frame has been run."""
    return df._jdf.queryExecution().executedPlan().toString()
