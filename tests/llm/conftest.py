from __future__ import annotations

import os

import pytest


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("given tables are not here")
    return path
