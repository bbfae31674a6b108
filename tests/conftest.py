import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kerbstone.plans.cut import clear_scratch  # noqa: E402
from kerbstone.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "8g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    clear_scratch(session)


@pytest.fixture(scope="session")
def small():
    return SMALL
