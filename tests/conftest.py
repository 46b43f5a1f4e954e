import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from eventide.session import get_session

    scratch = tempfile.mkdtemp(prefix="eventide-test-")
    s = get_session("local[8]", "eventide-tests", **{"spark.sql.shuffle.partitions": "8",
                                                     "spark.checkpoint.dir": scratch,
                                                     "spark.driver.memory": "8g"})
    yield s
    s.stop()
