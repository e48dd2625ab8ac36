from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import ensure_checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8, app_name="tidewater-tests")
    scratch = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    ensure_checkpoint_dir(session, scratch)
    yield session
    session.stop()


@pytest.fixture()
def lake(tmp_path):
    from tidewater.plans.common import LakePaths

    paths = LakePaths.under(str(tmp_path / "lake"))
    os.makedirs(paths.landing, exist_ok=True)
    return paths
