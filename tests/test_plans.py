"""The physical plans the library relies on."""

import re

import pytest

from ebbtide.functions.filters import LogFilter
from ebbtide.operators import explore
from ebbtide.plans.churn import churn_features, churn_features_joined
from ebbtide.plans.registry import all_queries
from ebbtide.sources.event_log import PAGES, event_log
from ebbtide.sources.jdbc import export_rows
from ebbtide.sources.lake import read_lake, write_lake


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "lake")
    write_lake(event_log(spark, sf_dir, items=True), path)
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_prunes_partitions(spark, lake):
    text = plan(read_lake(spark, lake, "2024-01-05", "2024-01-07"))
    assert re.search(r"PartitionFilters: \[.*date#\d+ >= 2024-01-05.*date#\d+ < 2024-01-07", text)


def test_panel_time_range_prunes_partitions(spark, lake):
    chosen = LogFilter(start="2024-01-05T10:00:00Z", end="2024-01-07T10:00:00Z", level=["paid"])
    text = plan(explore.value_counts(read_lake(spark, lake), "page", chosen))
    assert re.search(r"PartitionFilters: \[.*date#\d+ >= 2024-01-05.*date#\d+ <= 2024-01-07", text)
    assert "GreaterThanOrEqual(timestamp" in text


def test_only_needed_columns_are_read(spark, lake):
    text = plan(explore.distinct_values(read_lake(spark, lake), "auth"))
    assert "ReadSchema: struct<auth:string>" in text


def test_dashboard_is_one_scan(spark, lake):
    for df in (explore.value_distribution(read_lake(spark, lake)),
               explore.time_distribution(read_lake(spark, lake))):
        assert plan(df).count("FileScan") == 1


def test_fused_features_read_and_shuffle_less(spark, lake):
    log = read_lake(spark, lake)
    fused, joined = plan(churn_features(log, PAGES)), plan(churn_features_joined(log, PAGES))
    # Sessions, artists and pages are a scan each; only one row per user is joined.
    assert (fused.count("FileScan"), fused.count("Exchange hash")) == (3, 5)
    assert joined.count("FileScan") == 10
    # The song-grain branch reads three columns only.
    assert "ReadSchema: struct<artist:string,sessionId:int,userId:string>" in fused


def test_series_of_chosen_pages_prunes_partitions(spark, lake):
    chosen = LogFilter(start="2024-01-05T10:00:00Z", end="2024-01-07T10:00:00Z")
    text = plan(explore.downgrades_vs_upgrades(read_lake(spark, lake), filters=chosen))
    assert re.search(r"PartitionFilters: \[.*date#\d+ >= 2024-01-05.*date#\d+ <= 2024-01-07", text)


def test_export_keeps_the_parallelism_of_its_scan(spark, lake):
    text = plan(export_rows(read_lake(spark, lake), 16))
    assert "RoundRobinPartitioning(16)" in text and "Coalesce" not in text


def test_user_filter_reaches_the_scan(spark, lake):
    assert "IsNotNull(userId)" in plan(churn_features(read_lake(spark, lake), PAGES))


@pytest.mark.parametrize(
    "name", [n for n in all_queries() if n.split("_")[0] not in ("stream", "score", "compare", "pipeline") and not n.startswith("op")]
)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(all_queries()[name](spark, sf_dir))
    for operator in ("PythonUDF", "EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in text
