import pytest
from conftest_rows import SCHEMA, rows
from tidemill.llm.frames import importable


@pytest.fixture(scope="session")
def documents(spark):
    importable(spark)
    return spark.createDataFrame(rows(), SCHEMA).repartition(3, "n_chars", "text")


@pytest.fixture(scope="session")
def none(spark):
    importable(spark)
    return spark.createDataFrame([], SCHEMA)
