import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lendscope.session import get_session
    s = get_session("local[4]", 4, app_name="lendscope-tests",
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lendscope-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lendscope-test-")
