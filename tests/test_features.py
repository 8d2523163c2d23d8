import pytest
from pyspark.sql import functions as F

from ebbtide.operators import features as ft
from ebbtide.plans.churn import FLAG_NAMES, churn_features, churn_features_joined, join_families
from ebbtide.sources.event_log import PAGES, event_log
from tests.helpers import DAY_MS, START_MS, log, one


def song(session, artist="X", **fields):
    return {"sessionId": session, "page": "NextSong", "artist": artist} | fields


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    rows = [sorted(df.select(columns).collect(), key=repr) for df in (left, right)]
    assert rows[0] == rows[1]


def test_sessions_without_songs_are_not_in_the_mean(spark):
    df = log(spark, [song(1) for _ in range(4)] + [{"sessionId": 2}])
    assert one(ft.avg_songs_per_session(df))["avg_songs_per_session"] == 4.0
    assert one(churn_features(df))["avg_songs_per_session"] == 4.0


def test_user_without_songs(spark):
    row = one(churn_features(log(spark, [{}])))
    assert row["avg_songs_per_session"] == 0 and row["avg_num_artists_per_session"] == 0


def test_durations(spark):
    rows = [{"sessionId": 1}, {"sessionId": 2}, {"sessionId": 2, "ts": float(START_MS + DAY_MS)}]
    df = log(spark, rows)
    assert one(ft.avg_session_duration(df))["avg_session_duration_days"] == 0.5
    assert one(churn_features(df))["avg_session_duration_days"] == 0.5


def test_distinct_artists(spark):
    rows = [song(1, "X"), song(1, "X"), song(1, "Y"), song(2, "X"), song(3, None)]
    df = log(spark, rows)
    assert one(ft.avg_artists_per_session(df))["avg_num_artists_per_session"] == 1.5
    assert one(churn_features(df))["avg_num_artists_per_session"] == 1.5


def test_null_session_is_one_session(spark):
    df = log(spark, [song(None, "X"), song(None, "Y"), song(1, "X")])
    assert one(churn_features(df))["avg_num_artists_per_session"] == 1.5
    same(churn_features(df), churn_features_joined(df))


def test_null_page_is_counted(spark):
    df = log(spark, [{"page": None}, {}])
    assert one(ft.page_views(df))["null"] == 1
    assert one(churn_features(df))["null"] == 1


def test_leaking_pages_are_left_out(spark):
    df = log(spark, [{"page": "Downgrade"}, {"page": "Cancel"}, {"userId": "2", "page": "Submit Downgrade"}])
    frame = churn_features(df)
    assert one(frame)["churn"] == 0 and one(frame, "2")["churn"] == 1
    assert not {"Downgrade", "Cancel", "Submit Downgrade"} & set(frame.columns)


@pytest.mark.parametrize("page", ["Submit Downgrade", "Cancellation Confirmation"])
def test_churn_pages(spark, page):
    df = log(spark, [{}, {"page": page}, {"userId": "2"}])
    labels = {r.userId: r.churn for r in ft.churn_labels(df).collect()}
    assert labels == {"1": 1, "2": 0}


def test_user_agents_unknown(spark):
    df = log(spark, [{"userAgent": None}, {"userId": "2", "userAgent": None}, {"userId": "2"}])
    frame = churn_features(df)
    assert all(one(frame)[name] == 0 for name in FLAG_NAMES)
    mixed = one(frame, "2")
    assert mixed["uses_chrome"] == 1 and mixed["uses_firefox"] == 0
    assert mixed["uses_pc"] == 1 and mixed["uses_non_pc"] == 0 and mixed["uses_non_mobile"] == 1
    assert one(ft.browser_usage(df))["uses_chrome"] is None


def test_ios_pattern(spark):
    phone = "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2 like Mac OS X) Version/7.0 Mobile/1 Safari/1"
    df = log(spark, [{"userAgent": phone}])
    assert one(ft.os_usage(df))["uses_ios"] == 1
    assert one(ft.os_usage(df, "%ios%"))["uses_ios"] == 0
    assert one(churn_features(df, ios_pattern="%ios%"))["uses_ios"] == 0


def test_blank_users(spark):
    df = log(spark, [{"userId": None}, {"userId": ""}, {"userId": "2"}])
    assert {r.userId for r in churn_features(df).collect()} == {"", "2"}
    assert {r.userId for r in churn_features(df, drop_blank=True).collect()} == {"2"}


def test_summary(spark):
    df = log(spark, [{"userId": None, "page": "Submit Downgrade"}, {}, {"userId": "2", "page": "Submit Downgrade"}])
    assert tuple(ft.dataset_summary(df).first()) == (3, 2, 2, 1, 1)
    assert tuple(ft.dataset_summary(df.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_odd_page_names(spark):
    df = log(spark, [{"page": "a.b`c"}, {"page": "song's"}, {"page": "p0"}])
    row = one(churn_features(df))
    assert row["a.b`c"] == row["song's"] == row["p0"] == 1


ODD_PAGES = [None, "null", "NULL", "a.b", "a`b", "Home", "home", "churn", "userId", "uses_pc", "Help"]


def test_pages_with_clashing_names_keep_their_counts(spark):
    rows = [{"userId": u, "page": p} for u in ("1", "2") for n, p in enumerate(ODD_PAGES) for _ in range(n + 1)]
    df = log(spark, rows)
    for frame in (churn_features(df), churn_features_joined(df), ft.page_views(df)):
        names = [name.lower() for name in frame.columns]
        assert len(names) == len(set(names))
        pages = {f.name: f.metadata["page"] for f in frame.schema.fields if f.metadata.get("is_page")}
        assert sorted(pages.values(), key=str) == sorted(ODD_PAGES, key=str)
        for row in frame.collect():
            for name, page in pages.items():
                assert row[name] == ODD_PAGES.index(page) + 1


def test_many_pages_take_the_same_plan(spark):
    df = log(spark, [{"page": f"page {n % 300}"} for n in range(600)])
    row = one(churn_features(df))
    assert all(row[f"page {n}"] == 2 for n in range(300))


def test_no_feature_pages(spark):
    df = log(spark, [{"page": "Cancel"}])
    assert one(churn_features(df))["churn"] == 0
    assert ft.page_views(df).columns == ["userId"]


def test_join_key_matches_in_any_case(spark):
    labels = ft.churn_labels(log(spark, [{}, {"userId": "2"}]))
    other = spark.createDataFrame([("1", 5)], "userid string, n int")
    joined = join_families(labels, [other])
    assert sorted(joined.columns) == ["churn", "n", "userId"]
    assert {r.userId: r.n for r in joined.collect()} == {"1": 5, "2": 0}


def test_fused_equals_joined(spark, sf_dir):
    df = event_log(spark, sf_dir)
    same(churn_features(df, PAGES), churn_features_joined(df, PAGES))
    same(churn_features(df), churn_features_joined(df))


def test_hot_user_gives_the_same_result(spark, sf_dir):
    """A third of all rows under one user in one session, with many artists."""
    df = event_log(spark, sf_dir)
    hot = df.withColumns(
        {
            "userId": F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("userId")),
            "sessionId": F.when(F.col("event_id") % 3 == 0, 1).otherwise(F.col("sessionId")),
            "artist": F.when(F.col("page") == "NextSong", F.col("event_id").cast("string")),
        }
    )
    same(churn_features(hot, PAGES), churn_features_joined(hot, PAGES))
    row = one(churn_features(hot, PAGES), "hot")
    songs = hot.where("userId = 'hot' AND page = 'NextSong'").count()
    assert row["avg_num_artists_per_session"] == songs == row["NextSong"]


def test_too_many_pages(spark):
    df = log(spark, [{"page": "A"}, {"page": "B"}])
    for discover in (ft.discover_pages, lambda d, max_pages: churn_features(d, max_pages=max_pages)):
        with pytest.raises(ValueError):
            discover(df, max_pages=1)
    # Pages that are passed are not bounded.
    assert churn_features(df, ["A", "B"], max_pages=1).count() == 1


def test_unknown_device():
    with pytest.raises(ValueError):
        ft.device_flags("watch")


