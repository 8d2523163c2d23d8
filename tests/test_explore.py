import datetime as dt

import pytest

from ebbtide.functions.filters import LogFilter
from ebbtide.operators import explore
from ebbtide.plans.registry import all_queries
from ebbtide.sources.event_log import event_log
from tests.helpers import DAY_MS, START_MS, log


def test_shares_add_up(spark, sf_dir):
    df = event_log(spark, sf_dir)
    chosen = LogFilter(level=["paid"], status=[200, 307])
    rows = chosen.apply(df).count()
    for dim in explore.DIMENSIONS:
        counts = explore.value_counts(df, dim, chosen).collect()
        assert sum(r.value for r in counts) == rows
        assert sum(r.percent for r in counts) == pytest.approx(100)


def test_one_scan_dashboards_equal_single_panels(spark, sf_dir):
    df = event_log(spark, sf_dir)
    panels = {(r.panel, r.metric): (r.value, r.percent) for r in explore.value_distribution(df).collect()}
    series = {(r.time, r.panel, r.metric): r.value for r in explore.time_distribution(df, "12h").collect()}
    for dim in explore.DIMENSIONS:
        for r in explore.value_counts(df, dim).collect():
            assert panels.pop((dim, r.metric)) == (r.value, r.percent)
        for r in explore.time_counts(df, dim, "12h").collect():
            assert series.pop((r.time, dim, r.metric)) == r.value
    assert not panels and not series


def test_null_is_a_value(spark):
    df = log(spark, [{"gender": None}, {"gender": "F"}, {"method": None, "gender": "M"}])
    assert {r.metric for r in explore.value_counts(df, "gender").collect()} == {None, "F"}
    assert [r.gender for r in explore.distinct_values(df, "gender", ordered=True).collect()] == ["F", "M", None]


def test_status_is_text(spark):
    counts = explore.value_counts(log(spark, [{"status": 404}]), "status")
    assert counts.first().metric == "404"


def test_slices_and_ties(spark):
    rows = [{"page": p} for p in ("B", "A", "C", "C")]
    top = explore.top_pages(log(spark, rows), limit=2).collect()
    assert [(r.metric, r.value, r.percent) for r in top] == [("C", 2, 50.0), ("A", 1, 25.0)]


def test_snapshot_time(spark):
    row = explore.value_counts(log(spark, [{}]), "page", snapshot=True).first()
    assert isinstance(row.time, dt.datetime)


def test_series_are_ordered(spark):
    rows = [{"ts": float(START_MS + n * DAY_MS)} for n in (9, 2, 0)]
    series = explore.time_counts(log(spark, rows), "level", "7d").collect()
    assert [r.time for r in series] == sorted(r.time for r in series)
    # 1970-01-01 was a Thursday, and so is every 7d bucket.
    assert {r.time.weekday() for r in series} == {3}


def test_weekdays(spark):
    assert explore.weekday_counts(log(spark, [{}])).first().weekday == 2  # a Monday


def test_presets(spark):
    df = log(spark, [{"page": "Submit Upgrade"}, {"page": "Home", "status": 404}])
    assert [r.metric for r in explore.downgrades_vs_upgrades(df).collect()] == ["Submit Upgrade"]
    drill = {(r.panel, r.metric) for r in explore.status_drilldown(df).collect()}
    assert ("page", "Home") in drill and ("page", "Submit Upgrade") not in drill
    assert [r.metric for r in explore.free_vs_paid(df).collect()] == ["free"]


def test_unknown_dimension():
    with pytest.raises(ValueError):
        explore.dimension("song")


def test_results_do_not_depend_on_the_session_zone(spark, sf_dir):
    queries = all_queries()
    names = ["weekday", "series_level", "series_page_7d", "time_distribution", "counts_page", "log_timestamps"]
    run = lambda name: sorted(map(str, queries[name](spark, sf_dir).selectExpr("to_json(struct(*), map('timeZone', 'UTC'))").collect()))
    expected = {name: run(name) for name in names}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert {name: run(name) for name in names} == expected
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_identity_filter_would_show(spark, sf_dir, monkeypatch):
    queries = all_queries()
    names = ["counts_gender", "series_os", "top_pages", "weekday", "value_distribution", *[n for n in queries if n.startswith("counts_page_by_")]]
    run = lambda name: sorted(map(tuple, queries[name](spark, sf_dir).collect()), key=repr)
    expected = {name: run(name) for name in names}
    monkeypatch.setattr(LogFilter, "apply", lambda self, df: df)
    assert all(run(name) != expected[name] for name in names)
