import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def records(spark):
    """Build ingested records from tuples of the six fields; line_no counts from 0."""

    def make(rows, status="OK"):
        schema = (
            "line_no long, COD_ANU string, COD_ETU string, COD_ELP string, NOT_ELP string, "
            "COD_TRE string, COD_SES string, row_status string"
        )
        return spark.createDataFrame([(i, *row, status) for i, row in enumerate(rows)], schema)

    return make


@pytest.fixture
def lines(spark):
    def make(texts):
        return spark.createDataFrame(list(enumerate(texts)), "line_no long, raw_line string")

    return make
