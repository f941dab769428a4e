import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from forecourt import session
    s = session.build("local[4]", 4, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="forecourt-test-")})
    yield s
    s.stop()
