import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from foldline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app_name="foldline-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    """A fresh scratch folder per test (never reused or cleared)."""
    return tempfile.mkdtemp(prefix="foldline-test-")


def write_text(path, text):
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)
    return path
