import logging
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from feedloom.session import tune
    from oracle_check import session

    logging.disable(logging.CRITICAL)
    return tune(session())


@pytest.fixture
def shuffled(spark):
    """Joins without broadcast, so that the salted and sort-merge ways are taken."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, old)
