import pytest

from zonemill.llm.common import prepare


@pytest.fixture(autouse=True)
def _workers_can_import(spark):
    prepare(spark)
