import zipfile

import pytest

from veloclima import plans
from veloclima.operators import count_by_month
from veloclima.schema import TRIP_COLUMNS, WEATHER
from veloclima.sources import month_files

LINE = "{id},classic,{day} 23:50:00,{day} 23:59:00,{name},1,B,2,41.88,-87.63,41.89,-87.64,member"


def month(folder, stem, days, kind):
    lines = [LINE.format(id=f"{stem}{n}", day=d, name="" if n == 0 else "A") for n, d in enumerate(days)]
    text = "\n".join([",".join(TRIP_COLUMNS), *lines]) + "\n"
    if kind == ".zip":
        with zipfile.ZipFile(folder / f"{stem}-city-tripdata.zip", "w") as box:
            box.writestr(f"{stem}.csv", text)
    else:
        (folder / f"{stem}-city-tripdata.csv").write_text(text)


def test_month_files():
    assert month_files("/raw/", 2022, ["09", 10], ".csv") == "/raw/{202209,202210}-*.csv"


@pytest.mark.parametrize("kind", [".zip", ".csv"])
def test_from_files_to_report(spark, tmp_path, kind):
    files = tmp_path / "files"
    files.mkdir()
    month(files, "202209", ["2022-09-14", "2022-09-15", "2022-10-01"], kind)  # one stray
    month(files, "202210", ["2022-10-01", "2022-10-02"], kind)
    month(files, "202212", ["2022-12-24"], kind)
    raw, done = str(tmp_path / "raw"), str(tmp_path / "done")

    def ingest(months):
        again = len(months) == 1
        gaps = plans.ingest_months(spark, str(files), "2022", months, raw, kind, rebalance=again)
        return sorted(map(tuple, gaps.collect()))

    def held(path):
        return {r.month: r.n for r in count_by_month(spark.read.parquet(path)).collect()}

    assert ingest(["09", "10", "11"]) == [(2022, 11)]
    assert held(raw) == {9: 3, 10: 2, None: 5}
    assert ingest(["09"]) == []  # again: nothing doubles, October keeps its own
    assert held(raw) == {9: 3, 10: 2, None: 5}

    weather = str(tmp_path / "weather")
    days = [("2022-09-14", "rain", 20.0), ("2022-09-15", "snow", 1.0), ("2022-10-01", "rain", 9.0)]
    spark.createDataFrame(days, WEATHER).write.parquet(weather)
    plans.enrich_months(spark, raw, weather, done, 2022, ["09"])
    assert held(done) == {9: 3, None: 3}
    plans.enrich_months(spark, raw, weather, done, 2022, ["09"])
    assert held(done) == {9: 6, None: 6}
    plans.enrich_months(spark, raw, weather, done, 2022, ["09", "10"], replace=True)
    assert held(done) == {9: 3, 10: 1, None: 4}

    report = plans.report_days(spark, done, n=1).collect()
    assert [r.list for r in report] == ["highest", "lowest"]
    assert report[0].day == "2022-09-14"  # equal averages: the earlier day leads

    joined = str(tmp_path / "joined")
    plans.join_months(spark, raw, weather, joined)
    assert spark.read.parquet(joined).count() == 4
    assert "distance" not in spark.read.parquet(joined).columns


def test_absent_months_come_back_as_gaps(spark, tmp_path):
    (tmp_path / "files").mkdir()
    for months, want in (([1, 2], [(2022, 1), (2022, 2)]), ([], [])):
        gaps = plans.ingest_months(spark, str(tmp_path / "files"), 2022, months, str(tmp_path / "raw"))
        assert sorted(map(tuple, gaps.collect())) == want
    gaps = plans.ingest_and_enrich_months(
        spark, str(tmp_path / "files"), str(tmp_path / "w"), str(tmp_path / "out"), 2022, [3]
    )
    assert list(map(tuple, gaps.collect())) == [(2022, 3)]


def test_gaps_tell_what_was_there_then(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    month(files, "202209", ["2022-09-14"], ".csv")
    raw = str(tmp_path / "raw")
    first = plans.ingest_months(spark, str(files), 2022, [9, 10], raw, ".csv")
    month(files, "202210", ["2022-10-01"], ".csv")
    assert plans.ingest_months(spark, str(files), 2022, [10], raw, ".csv").isEmpty()
    assert list(map(tuple, first.collect())) == [(2022, 10)]


@pytest.fixture
def odd_weather(spark, tmp_path):
    """Weather with a year and a month of its own."""
    path = str(tmp_path / "weather")
    days = [(f"2022-{m}", "rain", 20.0, 1900, 7) for m in ("09-14", "09-30", "10-01", "10-02")]
    spark.createDataFrame(days, "datetime string, icon string, tempmax double, year int, month int").write.parquet(path)
    return path


def test_replacing_a_month_keeps_its_neighbours(spark, tmp_path, odd_weather):
    files, raw, done = tmp_path / "files", str(tmp_path / "raw"), str(tmp_path / "done")
    files.mkdir()
    month(files, "202209", ["2022-09-14", "2022-10-01"], ".csv")  # the second strays
    month(files, "202210", ["2022-10-01", "2022-10-02"], ".csv")
    plans.ingest_months(spark, str(files), 2022, [9, 10], raw, ".csv")

    def held():
        rows = spark.read.parquet(done).select("month", "ride_id", "year_y", "month_y").collect()
        assert {(r.year_y, r.month_y) for r in rows} <= {(1900, 7)}
        return sorted((r.month, r.ride_id) for r in rows)

    everything = [(9, "2022090"), (9, "2022091"), (10, "2022100"), (10, "2022101")]
    for months in ([9, 10], [9], [10]):
        plans.enrich_months(spark, raw, odd_weather, done, 2022, months, replace=True)
        assert held() == everything
    # September comes again without a single complete trip: its old rows go
    (files / "202209-city-tripdata.csv").write_text(
        ",".join(TRIP_COLUMNS) + "\n" + LINE.format(id="x", day="2022-09-14", name="A").replace("41.88", "") + "\n"
    )
    plans.ingest_months(spark, str(files), 2022, [9], raw, ".csv")
    plans.enrich_months(spark, raw, odd_weather, done, 2022, [9], replace=True)
    assert held() == everything[2:]


def test_csv_options_reach_the_jobs(spark, tmp_path, odd_weather):
    files = tmp_path / "files"
    files.mkdir()
    month(files, "202209", ["2022-09-14", "2022-09-30"], ".csv")
    path = files / "202209-city-tripdata.csv"
    path.write_text(path.read_text().replace(",A,", ',"A\nB",').replace("41.89", "N/A", 1))
    out = str(tmp_path / "out")
    options = {"null_words": ["N/A"], "multi_line": True, "null_text": None}
    plans.ingest_months(spark, str(files), 2022, [9], str(tmp_path / "raw"), ".csv", **options)
    rows = {r.ride_id: r for r in spark.read.parquet(str(tmp_path / "raw")).collect()}
    assert rows["2022090"].end_lat is None and rows["2022090"].start_station_name is None
    assert rows["2022091"].start_station_name == "A\nB"
    gaps = plans.ingest_and_enrich_months(
        spark, str(files), odd_weather, out, 2022, [9, 10], ".csv", replace=True, salt=4, **options
    )
    assert list(map(tuple, gaps.collect())) == [(2022, 10)]
    assert [r.ride_id for r in spark.read.parquet(out).collect()] == ["2022091"]


def test_a_coordinate_written_nan_is_missing(spark, tmp_path, odd_weather):
    text = {c: "x" for c in TRIP_COLUMNS} | {"started_at": "2022-09-14 08:00:00", "ended_at": "2022-09-14 08:10:00"}
    text |= {"start_lat": "41.8", "start_lng": "-87.6", "end_lat": "NaN", "end_lng": "-87.7"}
    raw = spark.createDataFrame([tuple(text.values())], list(TRIP_COLUMNS))
    weather = spark.read.parquet(odd_weather)
    assert plans.ingest_and_enrich(raw, weather).isEmpty()
    assert plans.enrich_trips(plans.ingest_trips(raw), weather).isEmpty()
