import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from candlewick.session import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .config("spark.checkpoint.dir", str(folder / "checkpoints"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def series(spark):
    """Build a one-symbol series from a list of closes, one row per minute."""

    def build(closes, symbol="a", start=dt.datetime(2024, 1, 1)):
        rows = [(symbol, start + dt.timedelta(minutes=i), None if c is None else float(c)) for i, c in enumerate(closes)]
        return spark.createDataFrame(rows, "symbol string, datetime timestamp, close double")

    return build


def values(df, column, order="datetime"):
    return [row[0] for row in df.orderBy(order).select(column).collect()]
