import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strata.lake import Lake  # noqa: E402
from strata.session import local_session, storage_root  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="strata-tests")
    storage_root(s)
    yield s
    s.stop()


@pytest.fixture()
def lake(spark, request):
    return Lake.fresh(spark, request.node.name[:40].replace("[", "_").replace("]", "_"))
