from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from cohort_test_tables import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from cohortlab.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app="cohortlab-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortlab-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def catalog():
    from cohortlab.plans import catalog as c
    c.load_all()
    return c


@pytest.fixture(scope="session")
def duck_small():
    from cohortlab.plans.verify import duck
    return duck(SF_SMALL)
