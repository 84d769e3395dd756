import datetime as dt
import re

import pytest

from conftest import plan_of
from veloclima import plans
from veloclima.operators import (
    add_date_key,
    add_distance,
    both_ends,
    count_table,
    daily_report_sql,
    drop_na_any,
    join_weather,
    limit_rows,
    register_view,
    report_weather_km,
    select_all_limit,
    top_distance,
    weather_daily_avg,
    weather_daily_avg_from_trips,
)
from veloclima.plans import daily_extremes
from veloclima.schema import WEATHER
from veloclima.sources import read_weather

ENRICHED = "date string, icon string, tempmax double, distance double"


@pytest.fixture
def enriched(spark):
    rows = [
        ("2022-09-14", "rain", 20.0, 100.0),
        ("2022-09-14", "rain", 20.0, 300.0),
        ("2022-09-14", "rain", 20.0, None),
        ("2022-09-15", None, None, 50.0),
        ("2022-09-15", None, None, 70.0),
        ("2022-09-16", "snow", -3.0, None),
        ("2022-09-17", "snow", -3.0, 200.0),
        ("2022-09-18", "snow", 20.0, 200.0),
    ]
    return spark.createDataFrame(rows, ENRICHED)


def test_groups_and_averages(enriched):
    got = {r.day: (r.icon, r.tempmax, r.distance) for r in weather_daily_avg(enriched).collect()}
    assert got == {
        "2022-09-14": ("rain", 20.0, 200.0),
        "2022-09-15": (None, None, 60.0),
        "2022-09-16": ("snow", -3.0, None),
        "2022-09-17": ("snow", -3.0, 200.0),
        "2022-09-18": ("snow", 20.0, 200.0),
    }


def test_tops_order_nulls_and_ties(enriched):
    report = weather_daily_avg(enriched)
    down = [r.day[-2:] for r in top_distance(report).collect()]
    up = [r.day[-2:] for r in top_distance(report, ascending=True).collect()]
    assert down == ["14", "17", "18", "15", "16"]
    assert up == ["16", "15", "14", "17", "18"]
    assert [r.day[-2:] for r in top_distance(report, 2).collect()] == ["14", "17"]


def test_both_ends_aggregates_once(enriched):
    ends = both_ends(weather_daily_avg(enriched), 2)
    plan = plan_of(ends, run=True).split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("TakeOrderedAndProject") == 2
    assert sorted((r.list, r.day[-2:]) for r in ends.collect()) == [
        ("highest", "14"),
        ("highest", "17"),
        ("lowest", "15"),
        ("lowest", "16"),
    ]


def test_sql_text_gives_the_same(spark, enriched):
    view = register_view(enriched, "t_report")
    want = sorted(map(str, weather_daily_avg(enriched).collect()))
    assert sorted(map(str, daily_report_sql(spark, view).collect())) == want


def test_kilometres_by_icon_and_by_temperature(enriched):
    rows = {(r.dimension, r.icon, r.tempmax): r for r in report_weather_km(enriched).collect()}
    assert len(rows) == 6
    assert rows[("icon", "snow", None)].avg_distance_km == 0.2
    assert rows[("icon", "snow", None)].n_trips == 3
    assert rows[("icon", None, None)].avg_distance_km == 0.06
    assert rows[("tempmax", None, None)].n_trips == 2
    assert rows[("tempmax", None, 20.0)].avg_distance_km == pytest.approx(0.2)


def test_counts_and_previews(enriched):
    assert count_table(enriched).first().n == 8
    assert select_all_limit(enriched, 3).count() == 3
    assert [r.distance for r in limit_rows(enriched.dropna(), 2, "distance").collect()] == [100, 200]


WEATHER_ROWS = [("2022-09-14", "rain", 20.5), ("2022-09-14", "rain", 20.5), ("2022-09-14", "snow", 1.0)]


def test_sums_before_the_join_equal_the_join_before_the_sums(spark, make_trips):
    moments = [dt.datetime(2022, 9, 14 + n % 3, n % 24) for n in range(60)]
    trips = make_trips(*[{"started_at": m, "end_lat": 41.88 + n / 1000} for n, m in enumerate(moments)])
    weather = spark.createDataFrame([*WEATHER_ROWS, ("2022-09-15", None, 3.0)], WEATHER)
    measured = add_distance(trips)
    direct = weather_daily_avg(join_weather(add_date_key(measured), weather))
    early = weather_daily_avg_from_trips(measured, weather)

    def plain(df):
        return sorted((r.day, str(r.icon), r.tempmax, round(r.distance, 6)) for r in df.collect())

    assert plain(early) == plain(direct) and len(plain(direct)) == 3


@pytest.fixture
def stored(spark, make_trips, tmp_path):
    trips, weather = str(tmp_path / "trips"), str(tmp_path / "weather")
    make_trips({}, {}).write.parquet(trips)
    spark.createDataFrame(WEATHER_ROWS, WEATHER).write.parquet(weather)
    return spark.read.parquet(trips), read_weather(spark, weather)


def test_the_plan_has_one_shuffle(spark, stored, conf):
    conf("spark.sql.adaptive.enabled", "false")
    trips, weather = stored
    measured = add_date_key(add_distance(drop_na_any(trips)))
    report = weather_daily_avg(join_weather(measured.select("date", "distance"), weather))
    plan = plan_of(top_distance(report))
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan)) == 1
    assert "BroadcastHashJoin" in plan and "TakeOrderedAndProject" in plan
    assert "partial_avg" in plan and "Sort " not in plan

    # Nothing broadcast: each side is gathered by day once, the report not again.
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    per_day = plan_of(weather_daily_avg_from_trips(measured, weather))
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", per_day) == ["date", "date"]


def test_the_report_over_a_stored_table_needs_no_python_and_four_columns(spark, stored, tmp_path):
    path = str(tmp_path / "enriched")
    plans.enrich_trips(*stored).write.parquet(path)
    plan = plan_of(top_distance(weather_daily_avg(spark.read.parquet(path))))
    assert "Python" not in plan
    assert "ReadSchema: struct<distance:double,date:string,icon:string,tempmax:double>" in plan


def test_unused_columns_are_not_read(stored):
    trips, weather = stored
    plan = plan_of(join_weather(add_date_key(trips), weather).select("ride_id", "icon"))
    assert "start_lat" not in plan


def test_generated_methods_stay_small_enough_to_compile(spark, stored, conf):
    """HotSpot leaves methods over 8000 bytes interpreted, some twenty times slower."""
    conf("spark.sql.adaptive.enabled", "false")
    trips, weather = stored
    for df in (plans.enrich_trips(trips, weather), plans.daily_extremes(trips, weather)):
        stages = df._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(n)._3().maxMethodCodeSize() for n in range(stages.size())]
        assert sizes and max(sizes) < 8000


def test_extremes_shuffle_no_single_trip(spark, stored, conf):
    """Broadcasts off: trips are summed by day in the scan's stage, whatever the day's share."""
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(daily_extremes(*stored))
    below = [plan[m.end() :].split("\n")[1] for m in re.finditer(r"Exchange hashpartitioning\(date#", plan)]
    assert below and any("partial_sum" in line for line in below)
    assert plan.count("ArrowEvalPython") == 1 or "ReusedExchange" in plan
