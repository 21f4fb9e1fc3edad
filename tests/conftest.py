import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stayledger.plans.warehouse_build import warehouse_for  # noqa: E402
from stayledger.session import local_session, shared_folder  # noqa: E402

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "6g")
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def house(spark):
    return warehouse_for(spark, TABLES)


@pytest.fixture(scope="session")
def tables_folder():
    return TABLES
