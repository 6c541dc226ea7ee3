import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import llm_fixtures  # noqa: E402
import pytest  # noqa: E402


@pytest.fixture(scope="session")
def doc_rows():
    return llm_fixtures.rows()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return llm_fixtures.frame(spark, doc_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return llm_fixtures.frame(spark, [])
