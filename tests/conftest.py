from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from forgeline.session import build_session

    spark = build_session(master="local[*]", shuffle_partitions=8, app_name="forgeline-tests")
    # tests set their own checkpoint folder only when the session names none
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="forgeline-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="forgeline-test-")
