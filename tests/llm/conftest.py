import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import ITEM, SCHEMA, documents  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM, "x"), (2, None, "x"), (3, "", "x"), (4, "the of and", "x"), (5, ITEM, "x")], "item_id long, text string, score string")
