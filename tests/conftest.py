import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from trendengine.session import build_session

    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw_frame(spark):
    """Raw rows from tuples (artist, id, genres, location, date, score)."""
    from trendengine.schemas import RAW_SCHEMA

    return lambda *rows: spark.createDataFrame(list(rows), RAW_SCHEMA)


@pytest.fixture
def clean_frame(spark):
    """Clean rows from tuples (artist, id, genres, location, date, score)."""
    from trendengine.schemas import CLEAN_SCHEMA

    return lambda *rows: spark.createDataFrame(list(rows), CLEAN_SCHEMA)
