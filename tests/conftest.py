import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from mirrorkit.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[*]",
        app_name="mirror-tests",
        # Few reducers: the tables of these tests are small.
        conf={"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "64"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="mirror-test-")


def rows_of(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
