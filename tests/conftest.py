import pytest

from curbline.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "curbline-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.sql.debug.maxToStringFields": "200",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
