import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_data import DOCUMENTS, edge_rows  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    """Rows with nulls, empty and very long texts, repeated rows and columns whose names clash with inner ones."""
    return spark.createDataFrame(edge_rows(), DOCUMENTS).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def small(spark):
    from alloy.sources.tables import read_table
    from conftest_data import SMALL

    return read_table(spark, SMALL, "documents").cache()
