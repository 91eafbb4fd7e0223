import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session

    s = build_session("local[4]", shuffle_partitions=4, app_name="tidewater-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
