import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from feedloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Apply a column function to Python values and give back the results in order."""
    from pyspark.sql import functions as F

    def run(function, items, kind="string"):
        rows = spark.createDataFrame(list(enumerate(items)), f"i long, v {kind}")
        return [r[0] for r in rows.select(function(F.col("v")).alias("r"), "i").orderBy("i").select("r").collect()]

    return run
