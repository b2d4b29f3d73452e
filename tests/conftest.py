import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from portal_metrics.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def star(spark):
    from portal_metrics.sources.tpch_star import star_from_tpch
    return star_from_tpch(spark, SF_SMALL)
