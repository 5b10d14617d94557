import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tallyrow.session import local_session

    return local_session(8, "tests")


@pytest.fixture(scope="session")
def sf():
    return SMALL


def rows(df, *columns):
    """Sorted tuples of the chosen columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture(scope="session")
def get():
    return rows
