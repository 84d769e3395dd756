import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import plan_of
from veloclima.operators import (
    cast_trips,
    clean_report,
    drop_index_col,
    drop_na_any,
    parse_timestamps,
    project_day_and_year,
    project_trips,
)
from veloclima.schema import TRIP_COLUMNS, TRIPS, TRIPS_TEXT


@pytest.fixture
def holed(make_trips):
    """One complete trip, then one missing value per column, then a NaN."""
    return make_trips({}, *[{c: None} for c in TRIP_COLUMNS], {"end_lng": float("nan")})


def test_drop_na_equals_dropna(holed):
    got = drop_na_any(holed).collect()
    assert got == holed.dropna(how="any").collect()
    assert [r.ride_id for r in got] == ["0"]
    assert drop_na_any(holed, ["end_lat", "end_lng"]).count() == 12


def test_clean_report_counts_the_same(holed):
    assert tuple(clean_report(holed).first()) == (15, 14, 1)


def test_the_filter_reaches_the_file_reader(spark, conf, holed, tmp_path, capsys):
    path = str(tmp_path / "t")
    holed.write.parquet(path)
    conf("spark.sql.maxMetadataStringLength", "5000")
    df = drop_na_any(spark.read.schema(TRIPS).parquet(path))
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "atleastnnonnulls" not in plan
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert all(f"IsNotNull({c})" in pushed for c in TRIP_COLUMNS)


def texts(spark, **override):
    row = dict.fromkeys(TRIP_COLUMNS, "1") | {
        "started_at": "2022-09-14 08:00:00",
        "ended_at": "2022-09-14 08:10:00.250",
        **override,
    }
    return spark.createDataFrame([tuple(row[c] for c in TRIP_COLUMNS)], TRIPS_TEXT)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unreadable_times(spark, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    good = parse_timestamps(texts(spark))
    assert dict(good.dtypes)["ended_at"] == "timestamp_ntz"
    assert good.first().ended_at.microsecond == 250_000
    assert parse_timestamps(texts(spark, ended_at=None)).first().ended_at is None
    bad = texts(spark, ended_at="yesterday")
    assert parse_timestamps(bad, on_error="null").first().ended_at is None
    with pytest.raises(PySparkException, match="yesterday"):
        parse_timestamps(bad).collect()


def test_cast_forces_columns_order_and_types(spark):
    shuffled = texts(spark).select(*reversed(list(TRIP_COLUMNS)), F.lit(1).alias("extra"))
    forced = cast_trips(shuffled)
    assert [(f.name, f.dataType) for f in forced.schema] == list(TRIP_COLUMNS.items())


def test_order_of_cleaning_and_text_decides(make_trips):
    """Text first keeps the trip without a station; cleaning first drops it."""
    trips = make_trips({}, {"start_station_name": None}, {"end_lat": None})
    text_first = drop_na_any(cast_trips(trips, null_text="nan"))
    clean_first = cast_trips(drop_na_any(trips), null_text="nan")
    real_nulls = drop_na_any(cast_trips(trips, null_text=None))
    assert [d.count() for d in (text_first, clean_first, real_nulls)] == [2, 1, 1]
    assert {r.start_station_name for r in text_first.collect()} == {"A", "nan"}


def test_projections(make_trips):
    trips = make_trips({}, {}, {}).withColumn("__index_level_0__", F.lit(1))
    assert drop_index_col(trips).columns == list(TRIP_COLUMNS)
    assert drop_index_col(drop_index_col(trips)).columns == list(TRIP_COLUMNS)
    row = project_day_and_year(trips).first()
    assert (row.year, row.start_year, row.date.hour) == ("2022-09-14", 2022, 8)
    dated = trips.withColumn("date", F.lit("2022-09-14"))
    assert project_trips(dated, 2, order_by="ride_id").columns == ["date", *TRIP_COLUMNS]
    assert project_trips(dated, 2).count() == 2 and project_trips(dated, None).count() == 3
    assert "TakeOrderedAndProject" in plan_of(project_trips(dated, 2, order_by="ride_id"))
