import random
import re
import shutil

import pytest
from pyspark.sql import functions as F

from ebbtide.functions.filters import LogFilter
from ebbtide.functions.timestamps import INTERVALS
from ebbtide.operators import explore
from ebbtide.plans import audience, cube
from ebbtide.sources.lake import read_lake, write_lake
from tests.helpers import DAY_MS, START_MS, log

MINUTE = 60_000


def row(day, minute, ms=0, **fields):
    return {"ts": float(START_MS + day * DAY_MS + minute * MINUTE + ms)} | fields


def random_log(seed, rows):
    pick = random.Random(seed)
    return [
        row(
            pick.randrange(40), pick.randrange(1440), pick.randrange(MINUTE), userId=str(pick.randrange(30)),
            page=pick.choice(["Home", "Help", None]), gender=pick.choice(["M", "F", None]), status=pick.choice([200, 404]),
            level=pick.choice(["free", "free", "free", "paid"]),
        )
        for _ in range(rows)
    ]


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


@pytest.fixture
def folders(spark, tmp_path):
    lake, stored = str(tmp_path / "lake"), str(tmp_path / "cube")
    write_lake(log(spark, random_log(1, 400)), lake)
    cube.update_cube(spark, lake, stored, "2018-10-01", "2019-01-01")
    return lake, stored


RANGES = [
    (None, None),
    ("2018-10-03T10:00:00Z", "2018-10-20T09:59:59.999999Z"),  # whole buckets only
    ("2018-10-03T10:00:00Z", "2018-10-20T10:00:00Z"),  # one more microsecond
    ("2018-10-03T10:02:11Z", "2018-10-20T10:03:59Z"),
    ("2018-10-03T10:02:11Z", None),
    (None, "2018-10-20T10:03:59Z"),
    ("2018-10-03T10:01:00Z", "2018-10-03T10:04:00Z"),  # within one bucket
    ("2018-10-03T10:01:00Z", "2018-10-03T10:05:00Z"),  # ends on the next one's start
    ("2018-10-03T10:01:00Z", "2018-10-03T10:09:00Z"),  # two cut buckets, none whole
    ("2018-10-09T10:00:00Z", "2018-10-03T10:00:00Z"),  # nothing
]


@pytest.mark.parametrize("start, end", RANGES)
def test_any_range_equals_the_log(spark, folders, start, end):
    filters = LogFilter(start=start, end=end, status=[200])
    rows = cube.cube_rows(spark, *folders, filters)
    same(cube.value_distribution(rows), explore.value_distribution(read_lake(spark, folders[0]), filters))
    same(cube.time_counts(rows, "gender", "6h"), explore.time_counts(read_lake(spark, folders[0]), "gender", "6h", filters))


def test_rows_on_the_edges_count_once(spark, tmp_path):
    lake, stored = str(tmp_path / "lake"), str(tmp_path / "cube")
    edges = [row(0, m, ms) for m in (0, 5, 10, 15, 20) for ms in (-1, 0, 1)]
    write_lake(log(spark, edges), lake)
    cube.update_cube(spark, lake, stored, "2018-09-01", "2019-01-01")
    times = ["00:00:00", "00:05:00", "00:09:59.999", "00:10:00", "00:10:00.001", "00:12:00", "00:15:00", "00:20:00"]
    for i, start in enumerate(times):
        for end in times[i : i + 4]:
            rows = cube.cube_rows(spark, lake, stored, LogFilter(f"2018-10-01T{start}Z", f"2018-10-01T{end}Z"))
            lower, upper = [sum(float(x) * f for x, f in zip(t.split(":"), (3600, 60, 1))) * 1000 for t in (start, end)]
            expected = sum(lower <= r["ts"] - START_MS <= upper for r in edges)
            assert rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] == expected, (start, end)


def test_all_widths_in_one_pass(spark, folders):
    rows = cube.cube_rows(spark, *folders)
    found = cube.time_resolutions(rows)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1 and "FileScan orc" not in text and text.count("Expand") == 1
    for interval in INTERVALS:
        expected = explore.time_distribution(read_lake(spark, folders[0]), interval)
        same(found.where(F.col("interval") == interval).drop("interval"), expected)
    assert {r.interval for r in found.select("interval").distinct().collect()} == set(INTERVALS)


def test_only_new_days_are_read(spark, folders):
    rows = cube.base_counts(read_lake(spark, folders[0], "2018-10-04", "2018-10-05"))
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*date#\d+ >= 2018-10-04.*date#\d+ < 2018-10-05", text)
    (scan,) = [line for line in text.splitlines() if "FileScan orc" in line]
    assert all(name in scan for name in cube.COLUMNS) and "userId" not in scan and "artist" not in scan


def test_cut_buckets_read_their_days_only(spark, folders):
    rows = cube.cube_rows(spark, *folders, LogFilter("2018-10-03T10:02:11Z", "2018-10-20T10:03:59Z"))
    text = rows._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan orc.*?PartitionFilters: \[(.*?)\]", text)
    days = [set(re.findall(r"date#\d+ [<>]= (\S+?)[,)]", scan)) for scan in scans]
    assert days == [{"2018-10-03"}, {"2018-10-20"}]
    assert re.search(r"FileScan parquet.*PartitionFilters: \[.*>= 2018-10-03.*<= 2018-10-20", text)


def test_replaced_and_removed_days(spark, folders, tmp_path):
    lake, stored = folders
    write_lake(log(spark, [row(1, 7, page="Later")]), lake)
    cube.update_cube(spark, lake, stored, "2018-10-02", "2018-10-03")
    same(cube.value_distribution(cube.cube_rows(spark, lake, stored)), explore.value_distribution(read_lake(spark, lake)
         .where("method IS NOT NULL AND status IS NOT NULL AND level IS NOT NULL AND auth IS NOT NULL AND page IS NOT NULL")))
    shutil.rmtree(tmp_path / "lake" / "date=2018-10-02")
    for _ in range(2):  # again: nothing changes
        cube.update_cube(spark, lake, stored, "2018-10-02", "2018-10-03")
        found = cube.cube_rows(spark, lake, stored)
        assert found.where("page = 'Later'").count() == 0
        assert found.agg(F.sum("n")).first()[0] == LogFilter().apply(read_lake(spark, lake)).count()


def test_empty_days(spark, tmp_path):
    lake, stored = str(tmp_path / "lake"), str(tmp_path / "cube")
    write_lake(log(spark, [row(0, 1)]), lake)
    cube.update_cube(spark, lake, stored, "2018-10-01", "2018-10-02")
    shutil.rmtree(tmp_path / "lake" / "date=2018-10-01")
    (tmp_path / "lake").mkdir(exist_ok=True)
    cube.update_cube(spark, lake, stored, "2018-10-01", "2018-10-02")
    rows = cube.cube_rows(spark, lake, stored)
    assert cube.value_distribution(rows).count() == 0 and cube.time_resolutions(rows).count() == 0


def test_session_zone_does_not_matter(spark, folders):
    filters = LogFilter("2018-10-03T10:02:11Z", "2018-10-20T10:03:59Z")
    run = lambda: sorted(map(tuple, cube.time_resolutions(cube.cube_rows(spark, *folders, filters))
                             .select("interval", F.unix_micros("time"), "panel", F.coalesce("metric", F.lit("-")), "value").collect()))
    expected = run()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
    try:
        assert run() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture
def sketched(spark, tmp_path):
    lake, stored = str(tmp_path / "lake"), str(tmp_path / "audience")
    ids = spark.range(60_000).select(
        (F.col("id") % 20_000).cast("string").alias("userId"), F.when(F.col("id") % 3 == 0, "paid").otherwise("free").alias("level"),
        F.expr("date_add(date '2018-10-01', cast(id % 7 as int))").alias("date"),
    )
    rows = ids.unionByName(spark.createDataFrame([("", "free"), ("", "paid"), (None, "paid")], "userId string, level string")
                           .withColumn("date", F.lit("2018-10-02").cast("date")))
    empty = log(spark, [{}]).where("false").drop("userId", "level", "date")
    write_lake(rows.unionByName(empty, allowMissingColumns=True), lake)
    audience.update_audience(spark, lake, stored, "2018-10-01", "2018-11-01")
    return lake, stored


def test_users_over_days_within_the_bound(spark, sketched):
    lake, stored = sketched
    for start, end in [("2018-10-01", "2018-10-08"), ("2018-10-02", "2018-10-03"), (None, "2018-10-04")]:
        days = read_lake(spark, lake, start, end).where("userId IS NOT NULL")
        (found,) = audience.users(audience.read_audience(spark, stored, start, end)).collect()
        exact = days.select("userId").distinct().count()
        assert found.rows == days.count() and abs(found.users - exact) <= audience.ERROR_BOUND * exact
        by_level = {r.level: r.users for r in audience.users(audience.read_audience(spark, stored, start, end), "level").collect()}
        for level, guess in by_level.items():
            exact = days.where(F.col("level") == level).select("userId").distinct().count()
            assert abs(guess - exact) <= audience.ERROR_BOUND * exact


def test_merge_order_does_not_matter(spark, sketched):
    stored = audience.read_audience(spark, sketched[1])
    once = audience.users(stored).first()
    for partitions in (1, 3, 14):
        assert audience.users(stored.repartition(partitions, F.rand(partitions))).first() == once
    by_day = stored.groupBy("date").agg(F.sum("rows").alias("rows"), F.hll_union_agg("users").alias("users"))
    assert audience.users(by_day).first() == once


def test_sketches_are_bounded(spark, sketched):
    stored = audience.read_audience(spark, sketched[1])
    assert stored.agg(F.max(F.length("users"))).first()[0] <= 2 ** audience.LG_K + 64


def test_blank_users_and_empty_ranges(spark, tmp_path):
    lake, stored = str(tmp_path / "lake"), str(tmp_path / "audience")
    write_lake(log(spark, [{"userId": ""}, {"userId": "a"}, {"userId": None}, {"userId": None, "ts": float(START_MS + DAY_MS)}]), lake)
    audience.update_audience(spark, lake, stored, "2018-10-01", "2018-11-01")
    days = audience.read_audience(spark, stored)
    assert [tuple(r) for r in audience.users(days).collect()] == [(2, 2)]
    assert [tuple(r) for r in audience.users(audience.read_audience(spark, stored, "2018-10-02")).collect()] == [(0, 0)]
    assert [str(r.date) for r in audience.users(days, "date").collect()] == ["2018-10-01"]
