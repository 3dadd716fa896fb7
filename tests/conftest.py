import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from recordloom.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture
def variants(spark):
    """Records from JSON texts, in order, as ``page, pos, v``."""
    from pyspark.sql import functions as F

    def build(*texts):
        rows = [(0, i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "page bigint, pos int, j string").select(
            "page", "pos", F.parse_json("j").alias("v")
        )

    return build


def as_dicts(df, *order):
    return [row.asDict() for row in (df.orderBy(*order) if order else df).collect()]
