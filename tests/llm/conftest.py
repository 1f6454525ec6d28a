import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from martlight.llm.common import ship
    ship(spark)
