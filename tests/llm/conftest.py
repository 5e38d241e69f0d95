import pytest

from tests.llm.helpers import hard_rows, table, with_clashes


@pytest.fixture(scope="session")
def hard(spark):
    return with_clashes(table(spark, hard_rows())).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return table(spark, [])
