import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fileflow.session import get_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4)
    yield s


@pytest.fixture
def scratch(spark, request):
    """A fresh folder under the session's checkpoint dir (a local path in tests)."""
    p = scratch_path(spark, request.node.name[:40])
    local = p[5:] if p.startswith("file:") else p
    os.makedirs(local, exist_ok=True)
    return local


@pytest.fixture
def employees():
    """Three employees (FIXTURES.md shape)."""
    return [
        (1, "Alice Smith", "Engineering", 95000.0, "2020-01-15"),
        (2, "Bob Jones", "Marketing", 72000.5, "2019-06-01"),
        (3, "Carol White", "Finance", 88000.0, "2021-03-20"),
    ]


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode(encoding) if isinstance(text, str) else text)
    return path
