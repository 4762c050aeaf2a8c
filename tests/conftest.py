import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from tidecast.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", 4)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).is_dir():
        pytest.skip("test tables are not here")
    return SF_DIR


@pytest.fixture(scope="session")
def frame(spark):
    """Make a small frame from rows, dates given as text."""
    import datetime as dt

    def make(schema, rows):
        parsed = spark.createDataFrame([], schema).schema
        kinds = [f.dataType.typeName() for f in parsed]

        def value(v, kind):
            if isinstance(v, str) and kind == "date":
                return dt.date.fromisoformat(v)
            if isinstance(v, str) and kind.startswith("timestamp"):
                return dt.datetime.fromisoformat(v)
            return float(v) if kind == "double" and v is not None else v

        return spark.createDataFrame([tuple(value(v, k) for v, k in zip(r, kinds)) for r in rows], parsed)

    return make


@pytest.fixture(scope="session")
def daily(frame):
    """A dense series ``a`` of n days from a start date, values by a function of the day index."""
    import datetime as dt

    def make(n, start="2024-01-01", value=lambda i: 100.0 + 10 * (i % 7) + i, series="a", missing=()):
        first = dt.date.fromisoformat(start)
        rows = [(series, (first + dt.timedelta(days=i)).isoformat(), value(i)) for i in range(n) if i not in missing]
        return frame("series_id string, date date, y double", rows)

    return make
