"""The same results in SQL, written from the rules and not from the Spark code."""

from __future__ import annotations

from numpy.polynomial.legendre import leggauss

EVENTS = "SELECT event_id AS i, ts, user_id, value FROM events"
ORDERS = """SELECT o_orderkey AS i,
       o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS ts,
       o_custkey AS user_id,
       o_totalprice % 500::DOUBLE AS value
FROM orders"""

TRIPS = """SELECT CAST(i AS VARCHAR) AS ride_id,
       CASE i % 4 WHEN 0 THEN 'electric_bike' WHEN 1 THEN 'classic'
                  WHEN 2 THEN 'docked_bike' ELSE 'classic_bike' END AS rideable_type,
       date_trunc('second', ts) AS started_at,
       date_trunc('second', ts) + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS ended_at,
       CASE WHEN i % 17 = 0 THEN NULL ELSE 'st' || (i % 97) END AS start_station_name,
       's' || (i % 97) AS start_station_id,
       'en' || (i % 89) AS end_station_name,
       'e' || (i % 89) AS end_station_id,
       start_lat,
       start_lng,
       CASE WHEN i % 41 = 0 THEN NULL WHEN i % 23 = 0 THEN start_lat
            ELSE start_lat + ((i * 31) % 4000 - 2000) / 100000::DOUBLE END AS end_lat,
       CASE WHEN i % 23 = 0 THEN start_lng
            ELSE start_lng + ((i * 37) % 4000 - 2000) / 100000::DOUBLE END AS end_lng,
       CASE WHEN user_id % 13 = 5 THEN 'guest' WHEN user_id % 3 = 0 THEN 'casual'
            ELSE 'member' END AS member_casual
FROM (SELECT *,
             41.65::DOUBLE + ((i * 7919) % 40000) / 100000::DOUBLE AS start_lat,
             -87.85::DOUBLE + ((i * 104729) % 30000) / 100000::DOUBLE AS start_lng
      FROM seeds)"""

WEATHER = """SELECT strftime(d, '%Y-%m-%d') AS datetime,
       CASE dayofmonth(d) % 4 WHEN 0 THEN 'rain' WHEN 1 THEN 'snow'
                              WHEN 2 THEN 'cloudy' ELSE 'clear-day' END AS icon,
       (dayofmonth(d) % 7) * 2.5::DOUBLE - 5 AS tempmax
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
WHERE dayofmonth(d) % 10 <> 0"""

HARSH = """SELECT * REPLACE (CASE WHEN CAST(ride_id AS BIGINT) % 29 = 0 THEN started_at - INTERVAL 90 SECOND
                          ELSE ended_at END AS ended_at) FROM all_trips"""
HARSH_WEATHER = """SELECT datetime, CASE WHEN dayofmonth(CAST(datetime AS DATE)) % 5 <> 0 THEN icon END AS icon,
       CASE WHEN dayofmonth(CAST(datetime AS DATE)) % 6 <> 0 THEN tempmax END AS tempmax FROM plain_weather
UNION ALL
SELECT datetime, 'fog', tempmax + 1 FROM plain_weather WHERE dayofmonth(CAST(datetime AS DATE)) % 7 = 0"""

# --- fixed values: the trip columns, in file order, and those that are text ---
COLUMNS = [
    "ride_id",
    "rideable_type",
    "started_at",
    "ended_at",
    "start_station_name",
    "start_station_id",
    "end_station_name",
    "end_station_id",
    "start_lat",
    "start_lng",
    "end_lat",
    "end_lng",
    "member_casual",
]
TEXTS = [
    "ride_id",
    "rideable_type",
    "start_station_name",
    "start_station_id",
    "end_station_name",
    "end_station_id",
    "member_casual",
]
# ------------------------------------------------------------------------------

COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in COLUMNS)


def listed(*extra: str) -> str:
    """The trip columns for output, times as text, then ``extra``."""
    out = []
    for c in COLUMNS:
        if c.endswith("_at"):
            out.append(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}")
        else:
            out.append(c)
    return ", ".join([*out, *extra])


def with_(ctes: list[tuple[str, str]], body: str) -> str:
    head = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {head}\n{body}"


def base(seeds: str = EVENTS) -> list[tuple[str, str]]:
    return [("seeds", seeds), ("trips", TRIPS)]


def measured(source: str) -> list[tuple[str, str]]:
    """CTEs ending in ``measured``: ``source`` with distance, travel_time and cost.

    The iteration for the ellipsoid is unrolled: eight rounds of chained CTEs.
    """
    f = "(1::DOUBLE / 298.257223563::DOUBLE)"
    ctes = [
        (
            "g0",
            f"SELECT *, (1 - {f}) * tan(radians(start_lat)) AS t1,"
            f" (1 - {f}) * tan(radians(end_lat)) AS t2,"
            f" radians(end_lng - start_lng) AS apart FROM {source}",
        ),
        ("g1", "SELECT *, 1 / sqrt(1 + t1 * t1) AS c1, 1 / sqrt(1 + t2 * t2) AS c2 FROM g0"),
        ("g2", "SELECT *, t1 * c1 AS s1, t2 * c2 AS s2, apart AS lam0 FROM g1"),
    ]
    last = "g2"
    for k in range(1, 9):
        keep = f"{', '.join(COLUMNS)}, c1, c2, s1, s2, apart"
        steps = [
            f"SELECT {keep}, lam{k - 1}, sin(lam{k - 1}) AS sl, cos(lam{k - 1}) AS cl FROM {last}",
            "SELECT *, sqrt(c2 * sl * c2 * sl + (c1 * s2 - s1 * c2 * cl) * (c1 * s2 - s1 * c2 * cl))"
            f" AS ss, s1 * s2 + c1 * c2 * cl AS cs FROM h{k}_0",
            "SELECT *, atan2(ss, cs) AS arc, CASE WHEN ss = 0 THEN 0 ELSE c1 * c2 * sl / ss END AS sa"
            f" FROM h{k}_1",
            f"SELECT *, 1 - sa * sa AS ca FROM h{k}_2",
            "SELECT *, CASE WHEN ca > 1e-12 THEN cs - 2 * s1 * s2 / ca ELSE 0 END AS mid,"
            f" {f} / 16 * ca * (4 + {f} * (4 - 3 * ca)) AS cc FROM h{k}_3",
            f"SELECT *, apart + (1 - cc) * {f} * sa * (arc + cc * ss * (mid + cc * cs *"
            f" (2 * mid * mid - 1))) AS lam{k} FROM h{k}_4",
        ]
        ctes += [(f"h{k}_{n}", sql) for n, sql in enumerate(steps)]
        last = f"h{k}_5"
    ctes += [
        ("e0", f"SELECT *, ca * (1 / ((1 - {f}) * (1 - {f})) - 1) AS u2 FROM {last}"),
        (
            "e1",
            "SELECT *, 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2))) AS aa,"
            " u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2))) AS bb FROM e0",
        ),
        (
            "e2",
            "SELECT *, bb * ss * (mid + bb / 4 * (cs * (2 * mid * mid - 1) - bb / 6 * mid *"
            " (4 * ss * ss - 3) * (4 * mid * mid - 3))) AS fix FROM e1",
        ),
        (
            "e3",
            f"SELECT {', '.join(COLUMNS)}, CASE WHEN abs(lam8 - lam7) <= 1e-10 THEN"
            f" round(6378137::DOUBLE * (1 - {f}) * aa * (arc - fix), 2) END AS distance,"
            " round_even((epoch_us(ended_at) - epoch_us(started_at)) / 60e6 * 10, 0) / 10"
            " AS travel_time FROM e2",
        ),
        # fixed values: the tariff
        (
            "measured",
            "SELECT *, round_even(CASE"
            " WHEN rideable_type = 'electric_bike' AND member_casual = 'member'"
            " THEN 1 + 0.17::DOUBLE * distance"
            " WHEN rideable_type = 'electric_bike' AND member_casual = 'casual'"
            " THEN 1 + 0.42::DOUBLE * distance"
            " WHEN rideable_type IN ('classic', 'docked_bike') AND member_casual = 'member'"
            " THEN 1 + 0.07::DOUBLE * distance"
            " WHEN rideable_type IN ('classic', 'docked_bike') AND member_casual = 'casual'"
            " THEN 1 + 0.15::DOUBLE * distance"
            " ELSE 0 END * 1000, 0) / 1000 AS cost,"
            " strftime(started_at, '%Y-%m-%d') AS date FROM e3",
        ),
    ]
    return ctes


NAN = "SELECT * REPLACE (" + ", ".join(f"coalesce({c}, 'nan') AS {c}" for c in TEXTS) + ") FROM trips"
PLUS = ("distance", "travel_time", "cost", "date", "icon", "tempmax")


# The archives: every 50th trip is in the next month's file, every 19th has a line break.
ARCHIVED = """SELECT * REPLACE (CASE WHEN CAST(ride_id AS BIGINT) % 19 = 0
                          THEN end_station_name || chr(10) || 'side'
                          ELSE end_station_name END AS end_station_name)
FROM all_trips"""
FILE_MONTH = (
    "2024 AS year, CAST(CASE WHEN CAST(ride_id AS BIGINT) % 50 = 0 THEN 2 ELSE 1 END AS INTEGER) AS month"
)


def archived() -> list[tuple[str, str]]:
    return [("seeds", EVENTS), ("all_trips", TRIPS), ("trips", ARCHIVED)]


def harsh() -> list[tuple[str, str]]:
    return [
        ("seeds", EVENTS), ("all_trips", TRIPS), ("trips", HARSH), ("plain_weather", WEATHER), ("weather", HARSH_WEATHER),
        ("clean", f"SELECT * FROM trips WHERE {COMPLETE}"), *measured("clean"),
        ("processed", "SELECT m.*, icon, tempmax FROM measured m JOIN weather ON date = datetime"),
    ]


def far() -> str:
    """Distance by halving the azimuth at the southern point, with integrals as sums.

    Another method than the iteration: 60 rounds of halving, and Gauss sums of 20 terms for
    both integrals of Bessel's sphere.
    """
    f = "(1::DOUBLE / 298.257223563::DOUBLE)"
    nodes, sums = leggauss(20)
    weights = "[" + ", ".join(f"{w / 2:.17g}" for w in sums) + "]"
    places = "[" + ", ".join(f"{(1 + x) / 2:.17g}" for x in nodes) + "]"

    def line(source: str, azimuth: str) -> str:
        """``source`` with the line that leaves at ``azimuth``: reached and metres."""
        k1 = f"SELECT *, sin({azimuth}) AS sa, cos({azimuth}) AS ca FROM {source}"
        k2 = (
            f"SELECT *, sa * c1 AS s0, sqrt(greatest(ca * ca * c1 * c1 + (s1 - s2) * (s1 + s2), 0)) / c2 AS cb FROM ({k1})"
        )
        k3 = f"SELECT *, atan2(s1, ca * c1) AS g1, atan2(s2, cb * c2) AS g2 FROM ({k2})"
        k4 = (
            f"SELECT *, (1 / ((1 - {f}) * (1 - {f})) - 1) * (1 - s0 * s0) AS k2,"
            f" atan2(s0 * sin(g2), cos(g2)) - atan2(s0 * sin(g1), cos(g1)) AS swing FROM ({k3})"
        )
        k5 = (
            f"SELECT *, list_transform({places}::DOUBLE[], lambda k: sqrt(1 + k2 * sin(g1 + (g2 - g1) * k)"
            f" * sin(g1 + (g2 - g1) * k))) AS roots FROM ({k4})"
        )
        return (
            f"SELECT *, swing - {f} * s0 * (g2 - g1) * list_dot_product("
            f"list_transform(roots, lambda r: (2 - {f}) / (1 + (1 - {f}) * r)), {weights}::DOUBLE[]) AS reached,"
            f" 6378137::DOUBLE * (1 - {f}) * (g2 - g1) * list_dot_product(roots, {weights}::DOUBLE[]) AS metres FROM ({k5})"
        )

    points = f"""SELECT CAST(i AS VARCHAR) AS ride_id, lat1, lng1,
       CASE WHEN i % 2 = 0 THEN 0::DOUBLE - lat1 + (-0.5::DOUBLE + ((i * 31) % 100) / 100::DOUBLE)
            ELSE -89.5::DOUBLE + ((i * 6007) % 17900) / 100::DOUBLE END AS lat2,
       CASE WHEN i % 2 = 0 THEN lng1 + 180::DOUBLE + (-1::DOUBLE + ((i * 37) % 200) / 100::DOUBLE)
            ELSE -180::DOUBLE + ((i * 15485863) % 36000) / 100::DOUBLE END AS lng2
FROM (SELECT event_id AS i, -89.5::DOUBLE + ((event_id * 7919) % 17900) / 100::DOUBLE AS lat1,
             -180::DOUBLE + ((event_id * 104729) % 36000) / 100::DOUBLE AS lng1 FROM events)"""
    return f"""WITH RECURSIVE points AS ({points}),
reduced AS (SELECT *, atan((1 - {f}) * tan(radians(lat1))) AS b1, atan((1 - {f}) * tan(radians(lat2))) AS b2,
                   lng2 - lng1 AS turn FROM points),
turned AS (SELECT *, abs(radians(turn - 360 * round_even(turn / 360, 0))) AS goal,
                  CASE WHEN abs(b1) < abs(b2) THEN b2 ELSE b1 END AS p, CASE WHEN abs(b1) < abs(b2) THEN b1 ELSE b2 END AS q
           FROM reduced),
placed AS (SELECT ride_id, goal, sin(-abs(p)) AS s1, cos(p) AS c1, sin(CASE WHEN p > 0 THEN -q ELSE q END) AS s2, cos(q) AS c2
           FROM turned),
halved AS (
    SELECT *, 0::DOUBLE AS low, pi() AS high, 0 AS n FROM placed
    UNION ALL
    SELECT ride_id, goal, s1, c1, s2, c2,
           CASE WHEN reached < goal THEN (low + high) / 2 ELSE low END,
           CASE WHEN reached < goal THEN high ELSE (low + high) / 2 END, n + 1
    FROM ({line("(SELECT * FROM halved WHERE n < 60)", "(low + high) / 2")})
)
SELECT ride_id, round(metres, 2) AS distance FROM ({line("(SELECT * FROM halved WHERE n = 60)", "(low + high) / 2")})"""


def processed() -> list[tuple[str, str]]:
    """Ingested (missing texts are 'nan'), cleaned, measured, joined."""
    return [
        *base(),
        ("weather", WEATHER),
        ("ingested", NAN),
        ("clean", f"SELECT * FROM ingested WHERE {COMPLETE}"),
        *measured("clean"),
        ("processed", "SELECT m.*, icon, tempmax FROM measured m JOIN weather ON date = datetime"),
    ]


def cleaned_first(source: list[tuple[str, str]] | None = None) -> list[tuple[str, str]]:
    """Cleaned with real NULLs, then measured and joined."""
    return [
        *(source or base()),
        ("weather", WEATHER),
        ("clean", f"SELECT * FROM trips WHERE {COMPLETE}"),
        *measured("clean"),
        ("processed", "SELECT m.*, icon, tempmax FROM measured m JOIN weather ON date = datetime"),
    ]


DAILY = (
    "SELECT date AS day, icon, tempmax, round(avg(distance), 4) AS distance"
    " FROM processed GROUP BY date, icon, tempmax"
)
TIES = "day NULLS FIRST, icon NULLS FIRST, tempmax NULLS FIRST"
HIGHEST = f"{DAILY} ORDER BY avg(processed.distance) DESC NULLS LAST, {TIES} LIMIT 10"
LOWEST = f"{DAILY} ORDER BY avg(processed.distance) ASC NULLS FIRST, {TIES} LIMIT 10"

YEAR_MONTH = (
    "CAST(year(started_at) AS INTEGER) AS year, CAST(month(started_at) AS INTEGER) AS month"
)
JOINED = (
    f"SELECT {{}} FROM (SELECT *, strftime(started_at, '%Y-%m-%d') AS date FROM {{}})"
    " JOIN weather ON date = datetime"
)


def month_counts(source: str, times: int = 1) -> str:
    return (
        f"SELECT year, month, {times} * count(*) AS n FROM"
        f" (SELECT {YEAR_MONTH} FROM {source}) GROUP BY GROUPING SETS ((year, month), ())"
    )


def oracle() -> dict[str, str]:
    trips, long = base(), base(ORDERS)
    weather = [("weather", WEATHER)]
    nan = [*trips, ("ingested", NAN)]
    done = processed()
    rows = f"SELECT {listed()} FROM trips"
    ingested = f"SELECT {listed()} FROM ingested"
    finished = f"SELECT {listed(*PLUS)} FROM processed"
    return {
        "src_csv_month": with_(trips, rows),
        "src_zip_csv": with_(archived(), f"SELECT {listed(FILE_MONTH)} FROM trips"),
        "src_parquet_nanos": with_(
            trips,
            "SELECT ride_id, epoch_us(started_at) + CAST(ride_id AS BIGINT) % 1000 * 1000 AS started_at,"
            " epoch_us(ended_at) + CAST(ride_id AS BIGINT) % 1000 * 1000 AS ended_at FROM trips",
        ),
        "src_parquet": with_(nan, ingested),
        "src_parquet_glob": with_(
            long,
            "SELECT ride_id, CAST(year(started_at) AS INTEGER) AS source_year,"
            " CAST(month(started_at) AS INTEGER) AS source_month FROM trips",
        ),
        "src_weather": with_(weather, "SELECT datetime, icon, tempmax FROM weather"),
        "src_table": with_(done, finished),
        "month_select": with_(
            long,
            f"SELECT {listed(YEAR_MONTH)} FROM trips"
            " WHERE year(started_at) = 1997 AND month(started_at) IN (1, 2, 3, 9)",
        ),
        "month_coverage": with_(
            long,
            "SELECT CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month FROM"
            " (SELECT unnest(generate_series(DATE '1994-07-01', DATE '2002-06-01',"
            " INTERVAL 1 MONTH)) AS m)"
            " WHERE m NOT IN (SELECT date_trunc('month', started_at) FROM trips)",
        ),
        "sink_parquet_month": with_(long, f"SELECT {listed(YEAR_MONTH)} FROM trips"),
        "sink_append": with_(trips, month_counts("trips", times=2)),
        "sink_overwrite": with_(nan, ingested),
        "sink_errorifexists": with_(nan, ingested),
        "sink_joined_parquet": with_(
            [*nan, *weather], JOINED.format(listed("date", "icon", "tempmax"), "ingested")
        ),
        "table_copy": with_(done, finished),
        "sink_idempotent_month": with_(
            done,
            f"SELECT year, month, count(*) AS n FROM (SELECT {FILE_MONTH} FROM processed)"
            " GROUP BY GROUPING SETS ((year, month), ())",
        ),
        "parse_timestamps": with_(trips, "SELECT ride_id, started_at, ended_at FROM trips"),
        "cast_trips": with_(nan, ingested),
        "drop_na_any": with_(trips, f"{rows} WHERE {COMPLETE}"),
        "rename_weather_key": with_(
            weather, "SELECT datetime AS date, icon, tempmax FROM weather"
        ),
        "add_date_key": with_(
            trips, "SELECT ride_id, strftime(started_at, '%Y-%m-%d') AS date FROM trips"
        ),
        "weather_date_text": with_(
            weather, "SELECT datetime AS date, icon, tempmax FROM weather"
        ),
        "project_trips": with_(
            trips,
            f"SELECT strftime(started_at, '%Y-%m-%d') AS date, {listed()} FROM trips"
            " ORDER BY ride_id LIMIT 100",
        ),
        "select_all_limit": with_(done, f"{finished} ORDER BY ride_id LIMIT 100"),
        "project_4_year": with_(
            trips,
            "SELECT ride_id, rideable_type, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS date,"
            " member_casual, strftime(started_at, '%Y-%m-%d') AS year,"
            " CAST(year(started_at) AS INT) AS start_year FROM trips",
        ),
        "drop_index_col": with_(trips, rows),
        "column_overlap": with_(
            [*trips, *weather, *measured("trips")],
            "SELECT ride_id, cost AS cost_x, tempmax * 10 AS cost_y"
            " FROM measured JOIN weather ON date = datetime",
        ),
        "join_weather": with_(
            [*trips, *weather], JOINED.format(listed("date", "icon", "tempmax"), "trips")
        ),
        "weather_daily_avg": with_(done, DAILY),
        "count_table": with_(done, "SELECT count(*) AS n FROM processed"),
        "count_multi_month": with_(long, month_counts("trips")),
        "count_before_clean": with_(
            trips,
            f"SELECT count(*) AS rows_before, count(*) FILTER (WHERE NOT ({COMPLETE}))"
            f" AS rows_dropped, count(*) FILTER (WHERE {COMPLETE}) AS rows_after FROM trips",
        ),
        "top10_distance_desc": with_(done, HIGHEST),
        "top10_distance_asc": with_(done, LOWEST),
        "limit_n": with_(
            weather, "SELECT datetime, icon, tempmax FROM weather ORDER BY datetime LIMIT 5"
        ),
        "add_distance": with_(
            [*trips, *measured("trips")], "SELECT ride_id, distance FROM measured"
        ),
        "add_travel_time": with_(
            trips,
            "SELECT ride_id, round_even((epoch_us(ended_at) - epoch_us(started_at)) / 60e6 * 10, 0)"
            " / 10 AS travel_time FROM trips",
        ),
        "add_cost": with_(
            [*trips, *measured("trips")],
            "SELECT ride_id, rideable_type, member_casual, distance, cost FROM measured",
        ),
        "day_format": with_(done, "SELECT ride_id, date AS day FROM processed"),
        "cast_to_text": with_(
            trips, "SELECT ride_id, strftime(started_at, '%Y-%m-%d') AS date FROM trips"
        ),
        "sql_view": with_(done, DAILY),
        "multi_month_union": with_(long, f"SELECT {listed(YEAR_MONTH)} FROM trips"),
        "pipe_ingest": with_(
            [*archived(), ("ingested", NAN)],
            f"SELECT {listed(FILE_MONTH)}, NULL AS gap FROM ingested UNION ALL BY NAME"
            " SELECT unnest(['2024-3', '2024-4']) AS gap",
        ),
        "pipe_enrich": with_(done, finished),
        "pipe_combined": with_(
            cleaned_first(archived()), f"SELECT {listed(*PLUS, FILE_MONTH)} FROM processed"
        ),
        "report_days": with_(
            done,
            f"SELECT *, 'highest' AS list FROM ({HIGHEST}) UNION ALL"
            f" SELECT *, 'lowest' AS list FROM ({LOWEST})",
        ),
        "harsh_index_col": with_(harsh(), rows),
        "harsh_travel_time": with_(
            harsh(),
            "SELECT ride_id, round_even((epoch_us(ended_at) - epoch_us(started_at)) / 60e6 * 10, 0)"
            " / 10 AS travel_time FROM trips",
        ),
        "harsh_join_weather": with_(harsh(), JOINED.format(listed("date", "icon", "tempmax"), "trips")),
        "harsh_daily_avg": with_(harsh(), DAILY),
        "add_distance_far": far(),
        "pipe_spark_join": with_(
            [*nan, *weather], JOINED.format(listed("date", "icon", "tempmax"), "ingested")
        ),
        "report_weather_km": with_(
            done,
            "SELECT CASE WHEN grouping(icon) = 0 THEN 'icon' ELSE 'tempmax' END AS dimension,"
            " icon, tempmax, count(*) AS n_trips, round(avg(distance) / 1000, 4) AS avg_distance_km"
            " FROM processed GROUP BY GROUPING SETS ((icon), (tempmax))",
        ),
        "daily_extremes": with_(
            cleaned_first(),
            f"SELECT *, 'highest' AS list FROM ({HIGHEST}) UNION ALL"
            f" SELECT *, 'lowest' AS list FROM ({LOWEST})",
        ),
        "weather_daily_avg_from_trips": with_(cleaned_first(), DAILY),
    }
