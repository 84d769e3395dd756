"""Every query against its SQL twin on the smallest data, as the driver does it."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from velo_contract import derived
from velo_contract.oracle import oracle
from velo_contract.queries import REGISTRY
from veloclima import plans
from veloclima.operators import clean_report, weather_daily_avg

DATA = Path("/root/testdata")
SMALL = str(DATA / "sf0.001")
TABLES = ["events", "orders"]

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda n: names[n])
    picked = [tuple(row[n] for n in order) for row in rows]
    return [names[n] for n in order], sorted(picked, key=lambda r: [(v is None, str(v)) for v in r])


def test_both_sides_name_the_same_queries():
    assert set(REGISTRY) == set(oracle())
    assert set(REGISTRY) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SMALL)
    result = duck.execute(contract.oracle_sql()[name])
    want = normal([c[0] for c in result.description], result.fetchall())
    got = normal(df.columns, df.collect())
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1]


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["day", "icon", "tempmax", "distance", "list"] and df.count() == 20


def test_figures_of_the_fixture_trial(spark):
    sf = str(DATA / "sf0.01")
    trips = derived.trips(spark, sf)
    assert tuple(clean_report(trips).first()) == (10_000, 818, 9_182)
    done = plans.ingest_and_enrich(trips, derived.weather(spark, sf))
    assert done.count() == 8_252
    report = weather_daily_avg(done)
    assert report.count() == 27
    first = report.filter("day = '2024-01-01'").first()
    assert (first.icon, first.tempmax, round(first.distance, 4)) == ("snow", -2.5, 1414.6507)
    means = done.filter("date = '2024-01-01'").selectExpr(
        "count(*)", "round(avg(travel_time), 4)", "round(avg(cost), 4)"
    )
    assert tuple(means.first()) == (334, 50.6147, 140.4521)
