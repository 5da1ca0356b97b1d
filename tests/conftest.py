from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clicklens.session import local_session

    s = local_session(8, app="clicklens-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh folder for one test (under /tmp; never reused)."""
    return tempfile.mkdtemp(prefix="clicklens-test-")


def one_col(spark, values, name="v"):
    """One string column holding ``values`` (None allowed), in order, with an id."""
    return spark.createDataFrame(list(enumerate(values)), f"id long, {name} string")
