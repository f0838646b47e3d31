import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from lakeledger.session import build_session, checkpoint_root
    s = build_session("local[4]", app="lakeledger-tests", shuffle_partitions=4)
    checkpoint_root(s)  # tests set their own only because none is configured
    yield s
    s.stop()


@pytest.fixture()
def hot(spark):
    """Lay rows out over many small partitions, so that every key spans several."""
    from lakeledger.operators.ordered import CONF_KEY
    spark.conf.set(CONF_KEY, "23")
    yield
    spark.conf.unset(CONF_KEY)
