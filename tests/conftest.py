import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from instalytics.session import local_session

    s = local_session(cores=4, shuffle_partitions=8, app="instalytics-tests")
    yield s


@pytest.fixture(scope="session")
def ctx():
    from instalytics import default_ctx

    return default_ctx()


@pytest.fixture(scope="session")
def fs(spark):
    from instalytics import catalog

    return catalog.feature_set(spark, SMOKE)
