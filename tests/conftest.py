import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomframe.session import local_session  # noqa: E402

LIMITS = ("cellRows", "broadcastRows", "blockRows")


@pytest.fixture(scope="session")
def spark():
    return local_session("tests")


@pytest.fixture
def split_limits(spark):
    """Tiny size limits, so that small data takes the plans of large data."""
    for name, value in zip(LIMITS, (300, 40, 100)):
        spark.conf.set(f"spark.loomframe.{name}", str(value))
    yield
    for name in LIMITS:
        spark.conf.unset(f"spark.loomframe.{name}")


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
