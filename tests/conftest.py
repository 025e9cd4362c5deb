import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sensorlake.schemas import READING  # noqa: E402
from sensorlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="sensorlake-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def readings(spark):
    """Build a READING frame from tuples
    (event_id, sensor_id, 'YYYY-mm-dd HH:MM:SS[.f]' | None, temperature, humidity[, source])."""
    def make(rows):
        out = []
        for r in rows:
            eid, sid, ts, t, h = r[:5]
            src = r[5] if len(r) > 5 else "csv"
            when = None if ts is None else dt.datetime.fromisoformat(ts).replace(tzinfo=dt.timezone.utc)
            out.append((eid, sid, when, t, h, src))
        return spark.createDataFrame(out, READING)
    return make


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
