import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from factorlab.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, app="factorlab-tests", driver_memory="4g")
    yield s


TINY = [
    ("U1", "A", 5.0), ("U1", "B", 3.0), ("U2", "A", 4.0), ("U2", "A", 2.0), ("U2", "C", 1.0),
    ("U3", "C", 4.7), (None, "B", 5.0), ("U4", None, 5.0), ("U5", "D", None),
]


@pytest.fixture()
def tiny(spark):
    return spark.createDataFrame(TINY, "reviewerID string, asin string, overall double")
