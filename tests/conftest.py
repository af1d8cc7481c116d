import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from seriesmart.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=4, shuffle_partitions=8, app="seriesmart-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from seriesmart.session import scratch_path
    return scratch_path(spark, "test")
