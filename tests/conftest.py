import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from contract.check import local_session
    from contract.registry import shared_folder
    from starq.session import configure

    session = configure(local_session(8))
    session.sparkContext.setLogLevel("ERROR")
    shared_folder(session)
    yield session
    session.stop()
