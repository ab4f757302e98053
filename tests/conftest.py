import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from rollcall.session import get_session
    s = get_session("local[4]", app="rollcall-tests", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="rollcall-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
