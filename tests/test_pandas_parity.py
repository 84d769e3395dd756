"""Enrichment against the same table worked out in pandas, on awkward random data."""

import numpy as np
import pandas as pd
import pytest

from veloclima import plans
from veloclima.functions import DEFAULT_TARIFF, ellipsoid_metres
from veloclima.operators import add_date_key, join_weather
from veloclima.schema import TRIPS, WEATHER


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 3000
    start = pd.Timestamp("2022-03-10") + pd.to_timedelta(rng.integers(0, 10 * 86400, n), unit="s")
    frame = pd.DataFrame(
        {
            "ride_id": [f"r{k}" for k in range(n)],
            "rideable_type": rng.choice(["electric_bike", "classic", "docked_bike", "x"], n),
            "started_at": start,
            "ended_at": start + pd.to_timedelta(rng.integers(-600, 9000, n), unit="s"),
            "start_station_name": rng.choice(["A", "nan", None], n),
            "start_station_id": rng.choice(["1", "02"], n),
            "end_station_name": "B",
            "end_station_id": "3",
            "start_lat": rng.uniform(41.6, 42.1, n),
            "start_lng": rng.uniform(-87.9, -87.5, n),
            "end_lat": rng.uniform(41.6, 42.1, n),
            "end_lng": np.where(rng.random(n) < 0.1, np.nan, rng.uniform(-87.9, -87.5, n)),
            "member_casual": rng.choice(["member", "casual", "guest"], n),
        }
    )
    return frame


@pytest.fixture(scope="module")
def weather():
    days = pd.date_range("2022-03-08", "2022-03-17").strftime("%Y-%m-%d").tolist()
    rows = [(d, ["rain", "snow", None][k % 3], k / 2) for k, d in enumerate(days) if k % 4 != 1]
    return pd.DataFrame([*rows, rows[3]], columns=WEATHER.names)  # one day twice


def as_spark(spark, frame, schema):
    rows = frame.astype(object).where(frame.notna(), None)
    stamps = {c: [v.to_pydatetime() for v in frame[c]] for c in frame if c.endswith("_at")}
    for c, values in stamps.items():
        rows[c] = pd.Series(values, dtype=object)
    return spark.createDataFrame([tuple(r) for r in rows.itertuples(index=False)], schema)


def in_pandas(frame, weather):
    out = frame.dropna().copy()
    metres = ellipsoid_metres(*[out[c].to_numpy() for c in TRIPS.names[8:12]])
    out["distance"] = [round(float(m), 2) for m in metres]
    minutes = (out["ended_at"] - out["started_at"]).dt.total_seconds() / 60
    out["travel_time"] = minutes.round(1)
    fares = {(bike, who): (base, rate) for bike, who, base, rate in DEFAULT_TARIFF}
    found = [fares.get(k, (0.0, 0.0)) for k in zip(out["rideable_type"], out["member_casual"])]
    base, rate = np.array(found).T
    out["cost"] = np.round(base + rate * out["distance"], 3)
    out["date"] = out["started_at"].dt.strftime("%Y-%m-%d")
    return out.merge(weather.rename(columns={"datetime": "date"}), on="date")


def test_enrichment(spark, frame, weather):
    got = plans.enrich_trips(as_spark(spark, frame, TRIPS), as_spark(spark, weather, WEATHER))
    got = got.toPandas()
    want = in_pandas(frame, weather)
    assert list(got.columns) == list(want.columns)
    assert 0 < len(want) == len(got)
    key = ["ride_id", "icon", "tempmax"]
    got, want = (d.sort_values(key).reset_index(drop=True) for d in (got, want))
    for column in want.columns:
        pd.testing.assert_series_equal(got[column], want[column], check_dtype=False, rtol=0, atol=0)


def test_colliding_names_follow_the_merge(spark, frame, weather):
    also = weather.assign(member_casual="w", wind=1.0)
    spark_weather = as_spark(spark, weather, WEATHER).selectExpr(
        "*", "'w' AS member_casual", "1.0D AS wind"
    )
    got = join_weather(add_date_key(as_spark(spark, frame, TRIPS)), spark_weather)
    dated = frame.assign(date=frame["started_at"].dt.strftime("%Y-%m-%d"))
    want = dated.merge(also.rename(columns={"datetime": "date"}), on="date")
    assert got.columns == list(want.columns)
    assert got.count() == len(want)
