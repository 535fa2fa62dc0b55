import pytest

from filingmill.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
