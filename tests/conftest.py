import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tollgate.session import checkpoint_root, get_session
    s = get_session("local[4]", app="tollgate-tests", shuffle_partitions=8)
    checkpoint_root(s)  # tests set their own checkpoint folder (unset here)
    yield s
    s.stop()
