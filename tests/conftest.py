import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import session  # noqa: E402
from shelfwise import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = configure(session("8", "4"))
    yield spark
    spark.stop()


@pytest.fixture
def shuffled(spark):
    """Joins as on data too large for any broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield spark
    for key in keys:
        spark.conf.unset(key)
