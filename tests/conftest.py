import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adledger.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")), "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """frame("a long, b string", rows): a small DataFrame."""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


@pytest.fixture
def apply(spark):
    """apply(column_function, values): the function over a one-column string table, in order."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, x {kind}")
        return [r["y"] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
