import pytest

from clickmill.schemas import TRACKING
from clickmill.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log(spark):
    """Builds an event log from dicts; what a dict leaves out is NULL."""

    def build(*events, bid_type="int"):
        fields = [f for f in TRACKING if f.name != "bid"]
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        rows = [tuple(e.get(f.name) for f in fields) + (e.get("bid"),) for e in events]
        return spark.createDataFrame(rows, f"{ddl}, bid {bid_type}")

    return build
