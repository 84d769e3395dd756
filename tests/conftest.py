from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from veloclima.schema import TRIPS  # noqa: E402
from veloclima.session import build_session, clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "veloclima-tests",
        master="local[4]",
        extra={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before: dict[str, str | None] = {}

    def set_(key: str, value: str) -> None:
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def make_trips(spark):
    """Trips from a few overrides each; everything else is a plain complete trip."""
    start = dt.datetime(2022, 9, 14, 8, 0, 0)
    plain = {
        "rideable_type": "electric_bike",
        "started_at": start,
        "ended_at": start + dt.timedelta(minutes=10),
        "start_station_name": "A",
        "start_station_id": "00123",
        "end_station_name": "B",
        "end_station_id": "7",
        "start_lat": 41.88,
        "start_lng": -87.63,
        "end_lat": 41.89,
        "end_lng": -87.64,
        "member_casual": "member",
    }

    def make(*overrides: dict):
        rows = [{"ride_id": str(n), **plain, **o} for n, o in enumerate(overrides)]
        return spark.createDataFrame([tuple(r[f] for f in TRIPS.names) for r in rows], TRIPS)

    return make


def plan_of(df, run: bool = False) -> str:
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
