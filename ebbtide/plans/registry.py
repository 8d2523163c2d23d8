"""Every operator as a runnable query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.filters import LogFilter, in_date_range, with_user
from ebbtide.functions.timestamps import utc_day
from ebbtide.operators import explore, features
from ebbtide.operators.evaluation import confusion, evaluate
from ebbtide.plans import audience, churn, cube, feature_state, training
from ebbtide.plans.ingest import enrich, ingest
from ebbtide.schema import LOG_SCHEMA, PARTITION_COLUMN, RAW_SCHEMA
from ebbtide.session import materialize, scratch_path
from ebbtide.sources.event_log import PAGES, event_log, raw_log, read_events, with_item_position
from ebbtide.sources.json_log import read_log_json, split_bad_records
from ebbtide.sources.lake import read_lake, register_views, write_lake
from ebbtide.streaming.ingest import ingest_stream
from ebbtide.streaming.series import count_stream, counts_so_far, late_counts, time_rows

Query = Callable[[SparkSession, str], DataFrame]

# The panels always carry a time range; this one cuts the tables at both ends.
RANGE = LogFilter(start="2024-01-05T06:00:00Z", end="2024-01-25T18:00:00Z")
SELECTIONS = {
    "method": ["GET"],
    "status": [200, 307],
    "level": ["paid"],
    "auth": ["Guest", "Logged Out"],
    "page": ["Home", "Help", "NextSong", "Submit Upgrade"],
}
# One row in so many has no value, so that the selections have NULLs to leave out.
PANEL_NULLS = {"method": 41, "status": 43, "level": 47, "auth": 53, "page": 59}
LAKE_START, LAKE_END = "2024-01-01", "2024-01-30"
EARLY_END = "2024-01-10"


def serving_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as the panels see it; ``date`` is a key of the lake, not a log column."""
    return event_log(spark, sf_dir).drop(PARTITION_COLUMN)


def panel_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with NULLs in the five columns that panels select by."""
    log = serving_log(spark, sf_dir)
    return log.withColumns(
        {name: F.when(F.col("event_id") % step != 0, F.col(name)) for name, step in PANEL_NULLS.items()}
    )


def on_panel(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: operator(panel_log(spark, sf_dir), *args, **kwargs)


def on_log(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: operator(serving_log(spark, sf_dir), *args, **kwargs)


def on_users(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: operator(with_user(serving_log(spark, sf_dir)), *args, **kwargs)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log as the 18 raw fields."""
    return raw_log(with_item_position(read_events(spark, sf_dir))).select(*RAW_SCHEMA.names)


def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_log(spark, sf_dir).select("event_id", "timestamp", "registration_timestamp", "date")


def user_agent_facets(df: DataFrame) -> DataFrame:
    facets = [name for name in LOG_SCHEMA.names if name.startswith("userAgent_")]
    return df.select("event_id", "userAgent", *facets)


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    raw_lines(spark, sf_dir).write.json(path)
    good, _ = split_bad_records(read_log_json(spark, path))
    return good


def lake_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lake")
    write_lake(event_log(spark, sf_dir, items=True), path)
    return read_lake(spark, path, LAKE_START, LAKE_END)


def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, serving_log(spark, sf_dir), "api_logs")
    return spark.sql(
        "SELECT level, gender, count(*) AS value FROM api_logs WHERE status = 404 "
        "GROUP BY level, gender"
    )


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "stream")
    raw_lines(spark, sf_dir).write.json(f"{base}/in")
    ingest_stream(spark, f"{base}/in", f"{base}/lake", f"{base}/checkpoint").awaitTermination()
    return read_lake(spark, f"{base}/lake")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the lake and bad lines by reason, from one stream over a log with faults."""
    base = scratch_path(spark, "stream")
    lines = lines_with_faults(spark, sf_dir)
    ingest_stream(spark, lines, f"{base}/lake", f"{base}/checkpoint", f"{base}/bad", 2).awaitTermination()
    bad = spark.read.schema("line string, reason string").json(f"{base}/bad")
    good = read_lake(spark, f"{base}/lake").select(F.lit("good").alias("reason"))
    return good.unionByName(bad.select("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("lines"))


def stream_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The pattern matches a single file and a folder of part files alike.
    base, path = scratch_path(spark, "series"), f"{sf_dir}/events.parquet*"
    events = spark.readStream.schema(read_events(spark, sf_dir).schema).parquet(path)
    count_stream(time_rows(enrich(raw_log(events)), "level"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return counts_so_far(spark, f"{base}/out")


LATE_STEP, SLICE_DAYS = 50, 8


def stream_series_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by day with how many of them came late: the log arrives in slices of some days, one row in
    fifty only after all others."""
    base, events = scratch_path(spark, "series"), read_events(spark, sf_dir)
    number = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / (86_400 * SLICE_DAYS))
    arrival = events.withColumn("slice", F.when(F.col("event_id") % LATE_STEP != 0, number))
    slices = sorted((r["slice"] is None, r["slice"]) for r in arrival.select("slice").distinct().collect())
    for _, wanted in slices:
        arrival.where(F.col("slice").eqNullSafe(F.lit(wanted))).drop("slice").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        count_stream(time_rows(enrich(raw_log(stream)), "level"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    late = late_counts(spark, f"{base}/out").groupBy("time", "metric").agg(F.sum("value").alias("late"))
    return counts_so_far(spark, f"{base}/out").join(late, ["time", "metric"], "left").fillna(0, "late")


LINE = f"to_json(struct({', '.join(RAW_SCHEMA.names)}))"
NO_TS = f"to_json(struct({', '.join(name for name in RAW_SCHEMA.names if name != 'ts')}))"
BROKEN_LINES = f"""
CASE WHEN event_id % 101 = 0 THEN '{{"page": "Home", "ts": '
     WHEN event_id % 103 = 0 THEN '{{}}'
     WHEN event_id % 107 = 0 THEN {NO_TS}
     WHEN event_id % 109 = 0 THEN replace({LINE}, '"ts":', '"ts":"soon","x":')
     WHEN event_id % 113 = 0 THEN replace({LINE}, '"ts":', '"ts":1e300,"x":')
     ELSE {LINE} END AS value"""


def lines_with_faults(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the log as JSON lines, some of them broken in one of five ways."""
    path = scratch_path(spark, "lines")
    raw_log(with_item_position(read_events(spark, sf_dir))).selectExpr(BROKEN_LINES).write.text(path)
    return path


def ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_path(spark, "lake")
    ingest(spark, lines_with_faults(spark, sf_dir), lake)
    return read_lake(spark, lake)


def ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "ingest")
    ingest(spark, lines_with_faults(spark, sf_dir), f"{base}/lake", f"{base}/bad")
    bad = spark.read.schema("line string, reason string").json(f"{base}/bad")
    return bad.groupBy("reason").agg(F.count("line").alias("lines"))


def ingest_replaces_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs into one lake: the second has the first days only, with every row paid."""
    base = scratch_path(spark, "days")
    raw = raw_lines(spark, sf_dir)
    raw.write.json(f"{base}/all")
    early = raw.where(F.col("ts") < 1_704_844_800_000).withColumn("level", F.lit("paid"))
    early.write.json(f"{base}/early")
    ingest(spark, f"{base}/all", f"{base}/lake")
    ingest(spark, f"{base}/early", f"{base}/lake")
    return read_lake(spark, f"{base}/lake")


def churn_features_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features from day states: all days first, early ones with wrong rows, then these replaced, then a last day.

    Sessions of the log last three days, so most of them lie in several day states.
    """
    base, log = scratch_path(spark, "state"), event_log(spark, sf_dir)
    wrong, last = F.col("date") < EARLY_END, F.col("date") >= LAKE_END
    first = log.where(~last).withColumns(
        {"page": F.when(wrong, F.lit("Cancellation Confirmation")).otherwise(F.col("page")),
         "artist": F.when(wrong, F.lit("nobody")).otherwise(F.col("artist"))}
    )
    write_lake(first, f"{base}/lake")
    feature_state.update_state(spark, f"{base}/lake", f"{base}/state", "2000-01-01", LAKE_END)
    write_lake(log.where(wrong | last), f"{base}/lake")
    feature_state.update_state(spark, f"{base}/lake", f"{base}/state", "2000-01-01", EARLY_END)
    feature_state.update_state(spark, f"{base}/lake", f"{base}/state", LAKE_END, "2100-01-01")
    return feature_state.features_from_state(spark, f"{base}/state", pages=PAGES)


# Cuts five-minute buckets at both ends.
CUT_RANGE = LogFilter(start="2024-01-05T06:01:40Z", end="2024-01-25T18:03:20Z")


def dated_panel_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel_log(spark, sf_dir).withColumn(PARTITION_COLUMN, utc_day(F.col("timestamp")))


def grown_lake(spark: SparkSession, log: DataFrame, base: str, update: Callable[..., None]) -> tuple[str, str]:
    """Lake and day table of ``log``: all days but the last first, early ones with wrong rows, then these
    replaced, then the last days."""
    lake, table = f"{base}/lake", f"{base}/table"
    wrong, last = F.col(PARTITION_COLUMN) < EARLY_END, F.col(PARTITION_COLUMN) >= LAKE_END
    spoilt = {"level": F.lit("none"), "userId": F.concat(F.lit("wrong "), "userId")}
    write_lake(log.where(~last).withColumns({k: F.when(wrong, v).otherwise(F.col(k)) for k, v in spoilt.items()}), lake)
    update(spark, lake, table, "2000-01-01", LAKE_END)
    write_lake(log.where(wrong | last), lake)
    update(spark, lake, table, "2000-01-01", EARLY_END)
    update(spark, lake, table, LAKE_END, "2100-01-01")
    return lake, table


def panel_cube(spark: SparkSession, sf_dir: str, filters: LogFilter = RANGE) -> DataFrame:
    log = dated_panel_log(spark, sf_dir)
    lake, table = grown_lake(spark, log, scratch_path(spark, "cube"), cube.update_cube)
    return cube.cube_rows(spark, lake, table, filters)


def on_cube(operator: Callable[..., DataFrame], *args, filters: LogFilter = RANGE) -> Query:
    return lambda spark, sf_dir: operator(panel_cube(spark, sf_dir, filters), *args)


def audience_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact users per level and over all, and whether the merged day sketches are within their bound."""
    log = event_log(spark, sf_dir)
    _, table = grown_lake(spark, log, scratch_path(spark, "audience"), audience.update_audience)
    chosen = in_date_range(with_user(log), LAKE_START, LAKE_END)
    sketches = audience.read_audience(spark, table, LAKE_START, LAKE_END)
    exact, guessed = [
        one("level").unionByName(one().withColumn("level", F.lit("all")))
        for one in (
            lambda *by: chosen.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("userId").alias("users")),
            lambda *by: audience.users(sketches, *by),
        )
    ]
    error = F.abs(F.col("guess") - F.col("users")) / F.col("users")
    return (
        exact.join(guessed.select("level", "rows", F.col("users").alias("guess")), ["level", "rows"], "left")
        .select("level", "rows", "users", F.coalesce(error <= audience.ERROR_BOUND, F.lit(False)).alias("within_bound"))
    )


def hash_split(df: DataFrame) -> DataFrame:
    users = df.select("userId").distinct()
    return users.select("userId", training.in_train().cast("int").alias("train"))


def label_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` as truth (quality) and prediction (toxic) pairs."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.select(
        F.col("quality").alias("churn"), F.col("toxic").cast("double").alias("prediction")
    )


def fused_features(df: DataFrame) -> DataFrame:
    return churn.churn_features(df, PAGES)


def with_null_pages(df: DataFrame) -> DataFrame:
    return df.withColumn("page", F.when(F.col("event_id") % PANEL_NULLS["page"] != 0, F.col("page")))


def score(df: DataFrame) -> DataFrame:
    """Predictions for the users that the model has not seen."""
    train_rows, test_rows = training.hash_split(materialize(fused_features(df), "features"))
    return training.score_users(training.train(train_rows, "dt"), test_rows)


def score_coverage(df: DataFrame) -> DataFrame:
    known = F.col("prediction").isin(0.0, 1.0)
    return score(df).agg(F.count(F.lit(1)).alias("users"), F.count_if(known).alias("scored"))


def planted_features(df: DataFrame) -> DataFrame:
    """Features of each user's sessions as users of their own, with a label that one of them decides."""
    users = df.withColumn("userId", F.concat("userId", F.lit("-"), "sessionId"))
    return fused_features(users).withColumn("churn", F.col("uses_ios"))


def score_planted(df: DataFrame) -> DataFrame:
    """Predictions of each planted label, from a model fitted on the other users."""
    train_rows, test_rows = training.hash_split(materialize(planted_features(df), "features"))
    scores = training.score_users(training.train(train_rows, "rf"), test_rows)
    return scores.select("userId", F.col("prediction").cast("int").alias("prediction"))


def compare_totals(df: DataFrame) -> DataFrame:
    found = training.compare(fused_features(df), ("dt", "lr"))
    return found.select(
        "classifier", (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("test_rows"),
        (F.col("fn") + F.col("tp")).alias("churned"),
    )


def all_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {}
    for name, column in explore.OVERVIEW.items():
        queries[f"distinct_{name}"] = on_log(explore.distinct_values, column)
    for name in explore.VARIABLES:
        queries[f"var_{name}"] = on_log(explore.distinct_values, name, ordered=True)
    for dim in explore.DIMENSIONS:
        queries[f"counts_{dim}"] = on_panel(explore.value_counts, dim, RANGE)
    for name, chosen in SELECTIONS.items():
        selected = replace(RANGE, **{name: chosen})
        queries[f"counts_page_by_{name}"] = on_panel(explore.value_counts, "page", selected)
    queries["top_pages"] = on_panel(explore.top_pages, RANGE, 5)
    for dim in explore.DIMENSIONS:
        queries[f"series_{dim}"] = on_panel(explore.time_counts, dim, "1d", RANGE)
    for width in ("10m", "30m", "1h", "6h", "12h", "14d"):
        queries[f"series_auth_{width}"] = on_panel(explore.time_counts, "auth", width, RANGE)
    queries |= {
        "series_page_7d": on_panel(explore.time_counts, "page", "7d", RANGE),
        "series_level_30d": on_panel(explore.time_counts, "level", "30d", RANGE),
        "series_method_5m": on_panel(explore.time_counts, "method", "5m", RANGE),
        "value_distribution": on_panel(explore.value_distribution, RANGE),
        "value_distribution_top": on_panel(
            explore.value_distribution, RANGE, {"page": 4, "level": 1}
        ),
        "time_distribution": on_panel(explore.time_distribution, "1d", RANGE),
        "drill_404": on_panel(explore.status_drilldown, 404, RANGE),
        "free_vs_paid": on_panel(explore.free_vs_paid, "1d", RANGE),
        "down_vs_upgrades": on_panel(
            explore.downgrades_vs_upgrades, filters=replace(RANGE, level=["paid"])
        ),
        "weekday": on_panel(explore.weekday_counts, RANGE),
        "sql_view": sql_view,
        "dataset_summary": on_log(features.dataset_summary),
        "churn_labels": on_users(features.churn_labels),
        "page_views": on_users(features.page_views, PAGES),
        "avg_songs_per_session": on_users(features.avg_songs_per_session),
        "avg_session_duration": on_users(features.avg_session_duration),
        "avg_artists_per_session": on_users(features.avg_artists_per_session),
        "browser_usage": on_users(features.browser_usage),
        "os_usage": on_users(features.os_usage),
    }
    for device in features.DEVICES:
        queries[f"{device}_usage"] = on_users(features.device_usage, device)
    queries |= {
        "page_views_discovered": on_users(lambda df: features.page_views(with_null_pages(df))),
        "churn_features_discovered": on_log(lambda df: churn.churn_features(with_null_pages(df))),
        "churn_features": on_log(fused_features),
        "churn_features_by_day": churn_features_by_day,
        "cube_resolutions": on_cube(cube.time_resolutions),
        "cube_distribution": on_cube(cube.value_distribution, filters=CUT_RANGE),
        "cube_series_cut": on_cube(cube.time_counts, "page", "5m", filters=replace(CUT_RANGE, level=["paid"])),
        "audience_by_level": audience_by_level,
        "churn_features_joined": on_log(churn.churn_features_joined, PAGES),
        "user_agent_facets": on_log(user_agent_facets),
        "log_timestamps": timestamps,
        "lake_roundtrip": lake_roundtrip,
        "json_roundtrip": json_roundtrip,
        "ingest_batch": ingest_batch,
        "ingest_quarantine": ingest_quarantine,
        "ingest_replaces_days": ingest_replaces_days,
        "hash_split": on_users(hash_split),
        "metrics": lambda spark, sf_dir: evaluate(label_predictions(spark, sf_dir)),
        "confusion": lambda spark, sf_dir: confusion(label_predictions(spark, sf_dir)),
        "compare_classifiers": on_log(lambda df: training.compare(fused_features(df))),
        "compare_mlp": on_log(lambda df: training.compare(fused_features(df), ("mlp",))),
        "compare_totals": on_log(compare_totals),
        "compare_planted": on_log(lambda df: training.compare(planted_features(df))),
        "score_users": on_log(score),
        "score_planted": on_log(score_planted),
        "score_coverage": on_log(score_coverage),
        "stream_ingest": stream_ingest,
        "stream_quarantine": stream_quarantine,
        "stream_series": stream_series,
        "stream_series_late": stream_series_late,
    }
    return queries
