import datetime as dt
import random
import zipfile

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veloclima import plans
from veloclima.schema import TRIP_COLUMNS, TRIPS, TRIPS_TEXT
from veloclima.sources import (
    PANDAS_NULL_WORDS,
    read_table,
    read_trips_csv,
    read_trips_parquet,
    read_trips_zip,
    timestamps_from_nanos,
    trips_from_archives,
)
from veloclima.sources import archives
from veloclima.sources.archives import packed

HEADER = ",".join(TRIP_COLUMNS)
LINE = "{id},classic,2022-09-14 08:00:00,2022-09-14 08:10:00,{name},00123,B,,41.88,-87.63,41.89,-87.64,member"


def csv_text(*lines, header=HEADER):
    return "\n".join([header, *lines]) + "\n"


def rows_of(df):
    return {r.ride_id: r for r in df.collect()}


def test_csv_keeps_text_and_reads_quotes(spark, tmp_path):
    file = tmp_path / "m.csv"
    file.write_text(
        csv_text(
            LINE.format(id="1", name='"Clark, St"'),
            LINE.format(id="2", name='"a ""b"" c"'),
            LINE.format(id="3", name='""'),
            LINE.format(id="4", name="NA"),
        )
    )
    df = read_trips_csv(spark, str(file))
    assert df.schema == TRIPS_TEXT
    rows = rows_of(df)
    assert rows["1"].start_station_name == "Clark, St" and rows["1"].start_station_id == "00123"
    assert rows["2"].start_station_name == 'a "b" c'
    assert rows["3"].start_station_name is None and rows["3"].end_station_id is None
    assert rows["4"].start_station_name == "NA"
    words = rows_of(read_trips_csv(spark, str(file), null_words=["NA", "null"]))
    assert words["4"].start_station_name is None and words["1"].start_station_name == "Clark, St"


def test_null_words_of_pandas(spark, tmp_path):
    file = tmp_path / "w.csv"
    words = [*PANDAS_NULL_WORDS, "na", "Null"]
    file.write_text(csv_text(*[LINE.format(id=n, name=w) for n, w in enumerate(words)]))
    missing = pd.read_csv(file, dtype=str)["start_station_name"].isna().tolist()
    rows = rows_of(read_trips_csv(spark, str(file), null_words=PANDAS_NULL_WORDS))
    assert [rows[str(n)].start_station_name is None for n in range(len(words))] == missing


def test_csv_refuses_another_layout(spark, tmp_path):
    (tmp_path / "a.csv").write_text(csv_text(header=HEADER.replace("start_lat", "from_latitude")))
    (tmp_path / "a.csv").open("a").write(LINE.format(id="1", name="A") + "\n")
    with pytest.raises(Exception, match="does not conform"):
        read_trips_csv(spark, str(tmp_path / "a.csv")).collect()
    (tmp_path / "b.csv").write_text(csv_text(LINE.format(id="1", name="A") + ",extra"))
    with pytest.raises(Exception, match="MALFORMED_RECORD|MALFORMED_CSV"):
        read_trips_csv(spark, str(tmp_path / "b.csv")).collect()


def test_several_csv_files_and_quoted_line_breaks(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"{n}.csv").write_text(csv_text(LINE.format(id=n, name='"two\nlines"')))
    paths = [str(tmp_path / f"{n}.csv") for n in (1, 2)]
    rows = rows_of(read_trips_csv(spark, paths, multi_line=True))
    assert {r.start_station_name for r in rows.values()} == {"two\nlines"} and len(rows) == 2


def archive(path, *members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as box:
        for name, text in members:
            box.writestr(name, text)


def test_zip_reads_the_first_member_only(spark, tmp_path):
    archive(
        tmp_path / "202209.zip",
        ("trips.csv", csv_text(LINE.format(id="1", name='"x, y"'), LINE.format(id="2", name=""))),
        ("more.csv", csv_text(LINE.format(id="9", name="Z"))),
    )
    archive(tmp_path / "202210.zip", ("trips.csv", csv_text(LINE.format(id="3", name="C"))))
    archive(tmp_path / "202211.zip")
    df = read_trips_zip(spark, f"{tmp_path}/*.zip")
    assert df.drop("source").schema == TRIPS_TEXT
    rows = rows_of(df)
    assert sorted(rows) == ["1", "2", "3"]
    assert rows["1"].start_station_name == "x, y" and rows["1"].start_station_id == "00123"
    assert rows["2"].start_station_name is None
    assert rows["3"].source.endswith("/202210.zip")
    assert plans.ingest_trips(df).count() == 3


def test_zip_and_csv_agree_over_many_blocks(spark, tmp_path):
    n = 150_000  # several blocks
    text = csv_text(*[LINE.format(id=i, name=f'"S {i % 7}, x"') for i in range(n)])
    (tmp_path / "m.csv").write_text(text)
    archive(tmp_path / "m.zip", ("m.csv", text))
    zipped = read_trips_zip(spark, str(tmp_path / "m.zip")).drop("source")
    plain = read_trips_csv(spark, str(tmp_path / "m.csv"))
    assert zipped.count() == n
    assert zipped.exceptAll(plain).isEmpty() and plain.exceptAll(zipped).isEmpty()


@pytest.mark.parametrize("header", [list(TRIP_COLUMNS)[::-1], [*TRIP_COLUMNS, "extra"], ["a", "b"]])
def test_zip_and_csv_refuse_another_header(spark, tmp_path, header):
    text = ",".join(header) + "\n" + ",".join("1" * len(header)) + "\n"
    archive(tmp_path / "m.zip", ("m.csv", text))
    (tmp_path / "m.csv").write_text(text)
    with pytest.raises(PySparkException):
        read_trips_zip(spark, str(tmp_path / "m.zip")).collect()
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_trips_csv(spark, str(tmp_path / "m.csv")).collect()


@pytest.mark.parametrize("n", [10, 300_000])
def test_zip_reads_line_breaks_in_quotes_at_any_size(spark, tmp_path, n):
    text = csv_text(*[LINE.format(id=i, name=f'"S {i}\nside"') for i in range(n)])
    assert n < 100 or len(text) > 3 * (8 << 20)
    archive(tmp_path / "m.zip", ("m.csv", text))
    by_path = read_trips_zip(spark, str(tmp_path / "m.zip"))
    whole = spark.read.format("binaryFile").load(str(tmp_path / "m.zip"))
    for rows in (by_path, trips_from_archives(whole)):
        good = F.col("start_station_name") == F.concat(F.lit("S "), "ride_id", F.lit("\nside"))
        assert tuple(rows.agg(F.count("*"), F.count_if(good)).first()) == (n, n)


def test_parquet_by_wildcard_knows_its_files(spark, make_trips, tmp_path):
    for month in ("202209", "202210"):
        make_trips({}, {}).write.parquet(f"{tmp_path}/{month}-tripdata.parquet")
    df = read_trips_parquet(spark, f"{tmp_path}/*-tripdata.parquet", with_source=True)
    found = df.groupBy(F.regexp_extract("source", r"(\d{6})-", 1).alias("m")).count().collect()
    assert {r.m: r["count"] for r in found} == {"202209": 2, "202210": 2}
    two = [f"{tmp_path}/{m}-tripdata.parquet" for m in ("202209", "202210")]
    assert read_trips_parquet(spark, two).count() == 4


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago"])
def test_nanosecond_files_of_pandas(spark, conf, tmp_path, zone):
    conf("spark.sql.session.timeZone", zone)
    stamp = pd.Timestamp("2022-03-13 02:30:00.123456789")
    early = pd.Timestamp("1969-12-31 23:59:59.999999500")
    frame = pd.DataFrame({"started_at": [stamp, early], "ended_at": [stamp, early]})
    path = str(tmp_path / "n.parquet")
    pq.write_table(pa.Table.from_pandas(frame), path, version="2.6")
    conf("spark.sql.legacy.parquet.nanosAsLong", "true")
    counts = T.StructType([T.StructField(c, T.LongType()) for c in ("started_at", "ended_at")])
    df = timestamps_from_nanos(spark.read.schema(counts).parquet(path))
    assert dict(df.dtypes)["started_at"] == "timestamp_ntz"
    assert sorted(r.started_at for r in df.collect()) == [
        dt.datetime(1969, 12, 31, 23, 59, 59, 999999),
        dt.datetime(2022, 3, 13, 2, 30, 0, 123456),
    ]


def test_nanoseconds_are_exact(spark):
    """Millisecond and microsecond times on both sides of 1970, where a double is too short."""
    rng = random.Random(3)
    micros = [rng.randrange(-(10**15), 3 * 10**15) for _ in range(2000)]
    micros += [m // 1000 * 1000 for m in micros]
    rows = [(m * 1000, m * 1000 + rng.randrange(1000)) for m in micros]
    df = timestamps_from_nanos(spark.createDataFrame(rows, "started_at long, ended_at long"))
    epoch = dt.datetime(1970, 1, 1)
    want = [epoch + dt.timedelta(microseconds=m) for m in micros]
    assert [tuple(r) for r in df.collect()] == [(w, w) for w in want]


def test_table_and_parallelism(spark, make_trips):
    make_trips(*[{}] * 12).write.mode("overwrite").saveAsTable("t_trips")
    assert read_table(spark, "t_trips").schema == TRIPS
    assert read_table(spark, "t_trips", parallelism=6).rdd.getNumPartitions() == 6


def test_import_needs_no_session(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    code = f"import sys; sys.path.insert(0, {str(root)!r}); import __spark_entry__ as e; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_archives_are_dealt_by_size():
    assert packed([5, 1, 9, 1, 1, 3], 2) == [[2, 3], [0, 5, 1, 4]]
    assert packed([1, 1], 8) == [[0], [1]] and packed([], 3) == []
    rng = random.Random(3)
    sizes = [rng.randint(1, 1000) for _ in range(200)]
    tasks = packed(sizes, 16)
    assert sorted(k for own in tasks for k in own) == list(range(200))
    loads = [sum(sizes[k] for k in own) for own in tasks]
    assert max(loads) - min(loads) <= max(sizes) and len(tasks) == 16


def test_every_archive_has_its_place_in_a_task(spark, tmp_path):
    for k in range(20):
        lines = [LINE.format(id=f"{k}-{n}", name="A") for n in range(1 + 50 * (k == 3))]
        archive(tmp_path / f"{k:06d}-x.zip", ("m.csv", csv_text(*lines)))
    df = read_trips_zip(spark, f"{tmp_path}/*.zip", tasks=5)
    assert df.rdd.getNumPartitions() == 5 and df.count() == 70
    own = df.select("source").distinct().groupBy(F.spark_partition_id()).count()
    assert df.select("source").distinct().count() == 20 and own.count() >= 1
    places = df.select("source", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(places) == 20 and len({r.task for r in places}) == 5
    large = next(r.task for r in places if r.source.endswith("000003-x.zip"))
    assert sum(r.task == large for r in places) < 5  # the large archive has fewer beside it
    assert read_trips_zip(spark, [str(tmp_path), f"{tmp_path}/000001*.zip"]).count() == 70  # each once


def test_archives_that_are_not_there_or_cannot_be_opened(spark, tmp_path, monkeypatch):
    with pytest.raises(FileNotFoundError, match="no archive matches"):
        read_trips_zip(spark, f"{tmp_path}/*.zip")
    archive(tmp_path / "m.zip", ("m.csv", csv_text(LINE.format(id="1", name="A"))))
    monkeypatch.setattr(archives, "listed", lambda spark, patterns: [("wasbs://a/b.zip", 10)])
    with pytest.raises(ValueError, match="wasbs://"):
        read_trips_zip(spark, "wasbs://a/*.zip")
    folder = str(tmp_path)

    def opener(path):
        return pafs.LocalFileSystem(), path.replace("wasbs://a/b.zip", f"{folder}/m.zip")

    rows = read_trips_zip(spark, "wasbs://a/*.zip", opener=opener).collect()
    assert [(r.ride_id, r.source) for r in rows] == [("1", "wasbs://a/b.zip")]


def test_a_row_longer_than_a_block(spark, tmp_path):
    lines = [LINE.format(id=k, name=f'"{"x" * (3_000_000 if k == 40 else 5)}"') for k in range(60)]
    archive(tmp_path / "m.zip", ("m.csv", csv_text(*lines)))
    with zipfile.ZipFile(tmp_path / "m.zip") as box:
        assert box.infolist()[0].file_size > 3_000_000
    rows = [r for b in small_blocks(tmp_path / "m.zip") for r in b.to_pylist()]
    assert [r["ride_id"] for r in rows] == [str(k) for k in range(60)] and len(rows[40]["start_station_name"]) == 3_000_000


def small_blocks(path):
    before, archives._BLOCK_BYTES = archives._BLOCK_BYTES, 1 << 12
    try:
        with archives.opened(str(path)) as file:
            yield from archives.first_member_rows(file, str(path))
    finally:
        archives._BLOCK_BYTES = before
