import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """The workers find the package wherever the tests are started from."""
    from carewatch.llm.common import ship_package
    ship_package(spark)
