import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from veloclima.functions import month_runs
from veloclima.operators import (
    count_by_month,
    count_table,
    month_coverage,
    month_select,
    months_between,
    multi_month_union,
)
from veloclima.sinks import write_months, write_table
from veloclima.sources import read_for_counts, read_table_for_counts, read_trips_parquet


@pytest.fixture
def trips(make_trips):
    moments = [
        dt.datetime(2021, 12, 31, 23, 59, 59),
        dt.datetime(2022, 1, 1),
        dt.datetime(2022, 2, 28, 23, 59, 59, 999999),
        dt.datetime(2022, 3, 1),
        dt.datetime(2022, 12, 31, 12),
        dt.datetime(2023, 1, 1),
    ]
    return make_trips(*[{"started_at": m} for m in moments])


def ids(df):
    return sorted(r.ride_id for r in df.collect())


def test_runs():
    assert month_runs(2022, ["02", "01", 5]) == [
        ("2022-01-01", "2022-03-01"),
        ("2022-05-01", "2022-06-01"),
    ]
    assert month_runs(2022, range(1, 13)) == [("2022-01-01", "2023-01-01")]
    assert month_runs(2022, []) == []
    with pytest.raises(ValueError):
        month_runs(2022, [13])


@pytest.mark.parametrize("zone", ["UTC", "Pacific/Auckland"])
def test_select_by_time_and_by_partition_agree(spark, conf, trips, tmp_path, zone):
    conf("spark.sql.session.timeZone", zone)
    path = str(tmp_path / "m")
    write_months(trips, path)
    stored = read_trips_parquet(spark, path)
    for months, want in [(["01", "02"], ["1", "2"]), ([12], ["4"]), ([], []), ([3, 1], ["1", "3"])]:
        assert ids(month_select(trips, 2022, months)) == want
        assert ids(month_select(stored, "2022", months)) == want


def test_other_months_are_never_opened(spark, trips, tmp_path, conf):
    conf("spark.sql.maxMetadataStringLength", "5000")
    path = str(tmp_path / "m")
    write_months(trips, path)
    chosen = month_select(read_trips_parquet(spark, path), 2022, [1, 2])
    assert "PartitionFilters: [isnotnull(year" in plan_of(chosen)
    assert len(chosen.inputFiles()) == len(read_trips_parquet(spark, path).inputFiles())
    assert chosen._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0

    flat = str(tmp_path / "flat")
    trips.write.parquet(flat)
    plan = plan_of(month_select(read_trips_parquet(spark, flat), 2022, [1, 2]))
    assert "GreaterThanOrEqual(started_at" in plan and "LessThan(started_at" in plan


def test_coverage(spark, trips):
    missing = month_coverage(trips, months_between(spark, "2021-11", "2022-04"))
    assert sorted(map(tuple, missing.collect())) == [(2021, 11), (2022, 4)]


def test_counts_and_total(trips, make_trips):
    rows = {(r.year, r.month): r.n for r in count_by_month(trips).collect()}
    assert rows[(None, None)] == 6 and rows[(2022, 1)] == 1 and len(rows) == 7
    assert [tuple(r) for r in count_by_month(trips.limit(0)).collect()] == [(None, None, 0)]


def test_union_keeps_duplicates_and_matches_names(trips):
    turned = trips.select(*reversed(trips.columns))
    assert ids(multi_month_union(trips, turned)) == sorted(ids(trips) * 2)
    with pytest.raises(ValueError):
        multi_month_union()


def test_coverage_looks_at_the_expected_years_only(spark, trips, tmp_path):
    stored = str(tmp_path / "by-month")
    write_months(trips, stored)
    plan = plan_of(month_coverage(spark.read.parquet(stored), months_between(spark, "2022-01", "2022-12")))
    assert re.search(r"PartitionFilters: \[[^\]]*year", plan)


def test_counts_come_from_footers(spark, trips, tmp_path, conf):
    """No column is read where all rows of files are counted, and the same is counted."""
    conf("spark.sql.maxMetadataStringLength", "5000")
    path = str(tmp_path / "by-month")
    write_months(trips, path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    stored, plain = read_for_counts(spark, path), read_trips_parquet(spark, path)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    for counted in (count_by_month, count_table):
        df = counted(stored)
        plan = plan_of(df)
        assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<count(*):bigint" in plan.replace("struct<year:int,month:int,count", "struct<count")
        assert "started_at" not in plan
        assert sorted(map(str, df.collect())) == sorted(map(str, counted(plain).collect()))
    wanted = months_between(spark, "2021-11", "2022-04")
    df = month_coverage(stored, wanted)
    assert "PushedAggregation: [COUNT(*)]" in plan_of(df)
    assert sorted(map(tuple, df.collect())) == [(2021, 11), (2022, 4)]
    # where rows are filtered, columns are read, and the rows still right
    some = count_table(stored.where("started_at < timestamp_ntz '2022-01-01 00:00:00'"))
    assert "PushedAggregation: [COUNT(*)]" not in plan_of(some) and some.first().n == 1


def test_a_catalog_table_is_counted_from_footers(spark, trips, tmp_path):
    write_table(trips, "t_footers", path=str(tmp_path / "a"))
    df = count_table(read_table_for_counts(spark, "t_footers"))
    assert "PushedAggregation: [COUNT(*)]" in plan_of(df) and df.first().n == 6
    trips.withColumn("m", F.month("started_at")).write.partitionBy("m").saveAsTable("t_parts")
    assert count_table(read_table_for_counts(spark, "t_parts")).first().n == 6
    trips.write.format("orc").saveAsTable("t_orc")
    assert count_table(read_table_for_counts(spark, "t_orc")).first().n == 6
    for name in ("t_footers", "t_parts", "t_orc"):
        spark.sql(f"DROP TABLE {name}")
