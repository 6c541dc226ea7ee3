import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from echolex.session import SESSION_CONF  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def _session():
    builder = SparkSession.builder.master("local[*]").appName("tests")
    conf = {
        **SESSION_CONF,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="echolex-tests-"),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


# Started on import: test modules build column expressions at their top level.
SESSION = _session()


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def texts(spark):
    """Build a one-column frame of texts with their position."""

    def build(values):
        return spark.createDataFrame(list(enumerate(values)), "i int, text string")

    return build


@pytest.fixture
def column_of(texts):
    """Values of an expression over a list of texts, in order."""

    def evaluate(values, expression):
        rows = texts(values).select("i", expression.alias("value")).collect()
        return [r["value"] for r in sorted(rows, key=lambda r: r["i"])]

    return evaluate
