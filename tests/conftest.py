import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from usagelens.schemas import CONTRACT, Star  # noqa: E402
from usagelens.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def make_star(spark):
    """A star from lists of tuples; tables not given are empty."""

    def make(**rows):
        tables = {}
        for name, schema in CONTRACT.items():
            tables[name] = spark.createDataFrame(rows.get(name, []), schema)
        return Star(**tables)

    return make


def rows_of(df):
    return [tuple(row) for row in df.collect()]
