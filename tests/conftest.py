import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from gleanframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    SparkSession.builder.master("local[8]").config("spark.driver.memory", "6g")
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ckpt-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Value of ``expression(column)`` for each string given."""
    from pyspark.sql import functions as F

    def run(values, expression, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").coalesce(1)
        return [row.o for row in rows.select("i", expression(F.col("v")).alias("o")).orderBy("i").collect()]

    return run
