import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def check(spark):
    """Run one column rule over a table of (input, expected) rows, in one job."""

    def run(rule, rows, kind="string"):
        from pyspark.sql import functions as F

        table = spark.createDataFrame(rows, f"input string, expected {kind}")
        got = table.select("input", "expected", rule(F.col("input")).alias("got")).collect()
        wrong = [(r.input, r.expected, r.got) for r in got if r.expected != r.got]
        assert not wrong, wrong

    return run
