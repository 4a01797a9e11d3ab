import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from newslens.session import local_session

    session = local_session("newslens-tests", cores=os.environ.get("TEST_CORES", "8"), partitions=4)
    yield session
    session.stop()
