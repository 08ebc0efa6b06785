import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from docklake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, 4)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(frame, *order):
    """Rows as tuples, sorted unless the frame's own order matters."""
    return sorted((tuple(r) for r in frame.collect()), key=repr) if not order else [tuple(r) for r in frame.collect()]
