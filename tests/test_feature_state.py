import re
import shutil

import pytest
from pyspark.sql import functions as F

from ebbtide.plans import feature_state
from ebbtide.plans.churn import churn_features
from ebbtide.sources.lake import read_lake, write_lake
from tests.helpers import DAY_MS, START_MS, log

MINUTE = 60_000
PAGES = ["Home", "NextSong", None]


def row(day, minute, user="1", session=1, **fields):
    return {"ts": float(START_MS + day * DAY_MS + minute * MINUTE), "userId": user, "sessionId": session} | fields


def song(day, minute, artist, **fields):
    return row(day, minute, page="NextSong", artist=artist, **fields)


LOG = [
    # One session over midnight, with an artist on both sides of it; another user's on one day.
    song(0, 1430, "a"), song(0, 1439, "b"), song(1, 5, "a"), song(1, 9, "c"), row(1, 10),
    song(0, 3, "a", user="2"), row(0, 4, user="2", page="Submit Downgrade"), row(2, 0, user="2", session=2, page=None),
    row(2, 3, user=None), row(2, 3, user=" ", session=9), row(3, 1, user="3", session=4, userAgent=None),
]


def same(a, b):
    assert a.columns == b.columns and [f.dataType for f in a.schema] == [f.dataType for f in b.schema]
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.fixture
def folders(spark, tmp_path):
    lake, state = str(tmp_path / "lake"), str(tmp_path / "state")
    write_lake(log(spark, LOG), lake)
    return lake, state


def test_state_grows_day_by_day(spark, folders):
    lake, state = folders
    for day in range(1, 5):
        feature_state.update_state(spark, lake, state, f"2018-10-0{day}", f"2018-10-0{day + 1}")
        end = f"2018-10-0{day + 1}"
        for blank in (False, True):
            same(
                feature_state.features_from_state(spark, state, None, end, PAGES, blank),
                churn_features(read_lake(spark, lake, None, end), PAGES, drop_blank=blank),
            )
    found = {r["userId"]: r for r in feature_state.features_from_state(spark, state).collect()}
    assert found["1"]["avg_num_artists_per_session"] == 3 and found["1"]["avg_session_duration_days"] == 20 / 1440
    same(feature_state.features_from_state(spark, state), churn_features(read_lake(spark, lake)))


def test_any_range_of_days(spark, folders):
    lake, state = folders
    feature_state.update_state(spark, lake, state, "2018-10-01", "2018-11-01")
    for start, end in [("2018-10-02", "2018-10-03"), ("2018-10-02", None), ("2018-10-07", "2018-10-09")]:
        same(
            feature_state.features_from_state(spark, state, start, end, PAGES),
            churn_features(read_lake(spark, lake, start, end), PAGES),
        )


def test_replaced_and_removed_days(spark, folders, tmp_path):
    lake, state = folders
    feature_state.update_state(spark, lake, state, "2018-10-01", "2018-11-01")
    write_lake(log(spark, [song(1, 7, "z"), row(1, 700, user="4", session=8)]), lake)
    feature_state.update_state(spark, lake, state, "2018-10-02", "2018-10-03")
    same(feature_state.features_from_state(spark, state, pages=PAGES), churn_features(read_lake(spark, lake), PAGES))
    shutil.rmtree(tmp_path / "lake" / "date=2018-10-03")
    feature_state.update_state(spark, lake, state, "2018-10-03", "2018-10-04")
    same(feature_state.features_from_state(spark, state, pages=PAGES), churn_features(read_lake(spark, lake), PAGES))
    feature_state.update_state(spark, lake, state, "2018-10-03", "2018-10-04")  # again: nothing changes
    assert feature_state.read_state(spark, state)["sessions"].where("date = '2018-10-01'").count() == 2


def test_only_new_days_and_partials_are_read(spark, folders):
    lake, state = folders
    new = read_lake(spark, lake, "2018-10-04", "2018-10-05")
    for rows in feature_state.day_states(new).values():
        text = rows._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") == 1 and re.search(r"PartitionFilters: \[.*date#\d+ >= 2018-10-04.*date#\d+ < 2018-10-05", text)
    feature_state.update_state(spark, lake, state, "2018-10-01", "2018-11-01")
    text = feature_state.features_from_state(spark, state, pages=PAGES)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan orc" not in text and text.count("FileScan parquet") == 3


def test_day_partials_are_small_and_exact(spark, folders):
    lake, state = folders
    feature_state.update_state(spark, lake, state, "2018-10-01", "2018-11-01")
    days = feature_state.read_state(spark, state, "2018-10-01", "2018-10-02")
    assert days["sessions"].where("userId = '1'").select(F.col("last_ts") - F.col("first_ts")).first()[0] == 9 * MINUTE
    assert sorted((r.userId, r.artist) for r in days["artists"].collect()) == [("1", "a"), ("1", "b"), ("2", "a")]
    assert {(r.userId, r.page): r.views for r in days["views"].collect()} == {
        ("1", "NextSong"): 2, ("2", "NextSong"): 1, ("2", "Submit Downgrade"): 1
    }
