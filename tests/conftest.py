import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsanalytics.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # No checkpoint folder is configured here: checkpoint_dir() makes one for the local session.
    s = get_session("local[4]", app_name="opsanalytics-tests", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture()
def out_dir(tmp_path):
    return str(tmp_path)
