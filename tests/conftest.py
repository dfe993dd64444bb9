from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pitwise.session import local_session

    s = local_session(4, shuffle_partitions=4, app="pitwise-tests")
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from pitwise.sources.fixtures import Tables

    return Tables(spark, SF_SMALL)


def rows(df, *cols):
    """Collected rows as tuples (tests only; inputs are a handful of rows)."""
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
