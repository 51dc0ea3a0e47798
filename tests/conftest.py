from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from signalstar.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "signalstar-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def rows(df):
    return [tuple(r) for r in df.collect()]


def as_set(df):
    return {tuple(r) for r in df.collect()}
