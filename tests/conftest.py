import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from lotscout.session import tuned  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tuned(session)
    session.stop()


@pytest.fixture
def one(spark):
    """Value of an expression over one row of text columns a, b, c, ..."""

    def run(expression, *values):
        names = "abcdefgh"[: len(values)]
        schema = ", ".join(f"{n} string" for n in names) or "x int"
        row = tuple(values) or (1,)
        return spark.createDataFrame([row], schema).select(expression.alias("v")).first()["v"]

    return run
