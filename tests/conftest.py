import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from landfall.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app="landfall-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def area(tmp_path):
    return str(tmp_path)


def write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def own_name(area: str) -> str:
    """A table name that no other test has."""
    import hashlib

    return "t_" + hashlib.md5(area.encode()).hexdigest()
