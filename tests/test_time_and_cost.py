import datetime as dt

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan_of
from veloclima.functions import DEFAULT_TARIFF, round_half_even
from veloclima.operators import add_cost, add_date_key, add_distance, add_travel_time, date_as_text
from veloclima.schema import TARIFF

T0 = dt.datetime(2022, 9, 14, 8, 0, 0)


def lasting(**delta):
    return {"started_at": T0, "ended_at": T0 + dt.timedelta(**delta)}


def minutes(df):
    return [r.travel_time for r in add_travel_time(df).orderBy("ride_id").collect()]


def test_ties_go_to_even_and_negative_times_stay(make_trips):
    trips = make_trips(
        lasting(seconds=3), lasting(seconds=9), lasting(seconds=-90), lasting(milliseconds=600)
    )
    assert minutes(trips) == [0.0, 0.2, -1.5, 0.0]


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Kolkata"])
def test_no_session_zone_bends_a_duration_or_a_day(make_trips, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    spring = {
        "started_at": dt.datetime(2022, 3, 13, 1, 30),
        "ended_at": dt.datetime(2022, 3, 13, 3, 30),
    }
    skipped = {  # an hour that a clock in Chicago never shows
        "started_at": dt.datetime(2022, 3, 13, 2, 15),
        "ended_at": dt.datetime(2022, 3, 13, 3, 15),
    }
    late = {
        "started_at": dt.datetime(2022, 3, 13, 23, 59, 59),
        "ended_at": dt.datetime(2022, 3, 13, 23, 58, 59),
    }
    trips = make_trips(spring, skipped, late)
    assert minutes(trips) == [120.0, 60.0, -1.0]
    assert {r.date for r in add_date_key(trips, as_text=True).collect()} == {"2022-03-13"}


def test_minutes_round_like_numpy(spark):
    seconds = np.arange(-7200, 172801)
    want = np.round(seconds / 60, 1)
    rows = spark.range(-7200, 172801, 1, 4).select(
        "id", round_half_even(F.col("id") / F.lit(60.0), 1).alias("m")
    )
    got = rows.orderBy("id").toPandas()["m"].to_numpy()
    assert np.array_equal(got, want)


@pytest.mark.parametrize("rate", [0.17, 0.42, 0.07, 0.15])
def test_costs_round_like_numpy(spark, rate):
    n = 400_000
    distance = np.arange(n) / 100
    want = np.round(1 + rate * distance, 3)
    price = F.lit(1.0) + F.lit(rate) * (F.col("id") / F.lit(100.0))
    rows = spark.range(0, n, 1, 4).select("id", round_half_even(price, 3).alias("c"))
    assert np.array_equal(rows.orderBy("id").toPandas()["c"].to_numpy(), want)


BIKES = ["electric_bike", "classic", "docked_bike", "classic_bike", None]
RIDERS = ["member", "casual", "guest", None]
RATES = {(b, m): r for b, m, _, r in DEFAULT_TARIFF}


@pytest.fixture
def every_cell(make_trips):
    cells = [{"rideable_type": b, "member_casual": m} for b in BIKES for m in RIDERS]
    return make_trips(*cells).withColumn("distance", F.lit(1000.0))


def expected(row):
    rate = RATES.get((row.rideable_type, row.member_casual))
    return 0.0 if rate is None else round(1 + rate * 1000.0, 3)


def test_every_cell_of_the_tariff(every_cell):
    rows = add_cost(every_cell).collect()
    assert len(rows) == 20
    assert all(r.cost == expected(r) for r in rows)
    assert sum(r.cost == 0 for r in rows) == 14


def test_tariff_as_a_table(spark, every_cell):
    table = spark.createDataFrame(list(DEFAULT_TARIFF), TARIFF)
    want = sorted(map(str, add_cost(every_cell).collect()))
    assert sorted(map(str, add_cost(every_cell, table).collect())) == want
    wider = table.union(
        spark.createDataFrame([("classic_bike", "member", 2.0, 0.5)], TARIFF)
    )
    got = add_cost(every_cell, wider).filter("rideable_type = 'classic_bike'").collect()
    assert sorted(r.cost for r in got) == [0.0, 0.0, 0.0, 502.0]


def test_a_tariff_must_be_unambiguous(spark, every_cell):
    with pytest.raises(ValueError):
        add_cost(every_cell, [*DEFAULT_TARIFF, DEFAULT_TARIFF[0]])
    twice = spark.createDataFrame([*DEFAULT_TARIFF, DEFAULT_TARIFF[0]], TARIFF)
    with pytest.raises(PySparkException, match="two tariff rows"):
        add_cost(every_cell, twice).collect()


def test_unknown_distance_gives_no_price_but_an_unknown_bike_costs_nothing(make_trips):
    trips = add_distance(make_trips({"end_lat": None}, {"end_lat": None, "member_casual": "x"}))
    costs = {r.ride_id: r.cost for r in add_cost(trips).collect()}
    assert costs == {"0": None, "1": 0.0}


def test_cost_by_time_is_an_option(make_trips):
    timed = add_travel_time(make_trips({}))
    assert add_cost(timed, basis="travel_time").first().cost == 2.7
    with pytest.raises(ValueError):
        add_cost(timed, basis="weight")


def test_day_is_a_date_inside_and_text_outside(make_trips):
    dated = add_date_key(make_trips({}))
    assert dict(dated.dtypes)["date"] == "date"
    assert date_as_text(dated).first().date == "2022-09-14"


def test_a_tariff_in_memory_does_not_shuffle_trips(spark, every_cell):
    table = spark.createDataFrame(list(DEFAULT_TARIFF), TARIFF)
    plan = plan_of(add_cost(every_cell, table), run=True)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_tariff_beyond_the_threshold_is_salted(spark, every_cell, conf):
    table = spark.createDataFrame(list(DEFAULT_TARIFF), TARIFF)
    want = {r.ride_id: r.cost for r in add_cost(every_cell, table).collect()}
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    salted = add_cost(every_cell, table, salt=4)
    assert "_salt" in plan_of(salted)
    assert {r.ride_id: r.cost for r in salted.collect()} == want
