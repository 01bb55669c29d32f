import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """frame(rows, schema): a DataFrame of two partitions."""
    return lambda rows, schema: spark.createDataFrame(rows, schema).repartition(2)
