import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from agora.session import build_session

    # Tests own their checkpoint folder (a cluster would name a shared one).
    ckpt = tempfile.mkdtemp(prefix="agora-test-ckpt-")
    session = build_session(
        "local[4]", app_name="agora-tests", shuffle_partitions=4,
        extra_conf={
            "spark.checkpoint.dir": ckpt,
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="agora-test-wh-"),
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="agora-test-")
