"""Feature state by day: a nightly run reads the new days of the log and nothing else of it.

Per day of the lake the state holds three tables, partitioned by ``date``:

* ``sessions``: user, session, first and last time, songs, churn, flags: one row a session and day;
* ``artists``: the distinct (user, session, artist) of the day;
* ``views``: rows per user and page.

All of them merge over days: times by minimum and maximum, counts by sum, flags by maximum, artist
sets by union. A session that goes over midnight is in two days and one session again after merging.
Artist sets are rows, not bitmaps or lists: a hot session spreads over its artists, no numbering of
artists has to be kept, and a set of a few artists takes a few dozen bytes.

A day that is written again replaces its partitions, so the state of a replaced day is replaced by
running :func:`update_state` for that day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.filters import Moment, in_date_range, with_user
from ebbtide.operators import features as ft
from ebbtide.operators.features import SESSION, USER
from ebbtide.plans.churn import FLAG_NAMES, fused, session_measures, with_pages
from ebbtide.schema import PARTITION_COLUMN
from ebbtide.sources.lake import read_lake, store_days

SESSIONS, ARTISTS, VIEWS = "sessions", "artists", "views"
SCHEMAS = {
    SESSIONS: f"{USER} string, {SESSION} int, first_ts double, last_ts double, songs bigint, churn int, with_artist int, "
    + ", ".join(f"{name} int" for name in FLAG_NAMES)
    + f", {PARTITION_COLUMN} date",
    ARTISTS: f"{USER} string, {SESSION} int, artist string, {PARTITION_COLUMN} date",
    VIEWS: f"{USER} string, page string, views bigint, {PARTITION_COLUMN} date",
}


def day_states(log: DataFrame, ios_pattern: str = ft.IOS_PATTERN) -> dict[str, DataFrame]:
    """The three tables of the days in ``log``."""
    day = PARTITION_COLUMN
    measures = {name: column for name, column in session_measures(ios_pattern).items() if name != "span"}
    sessions = log.groupBy(USER, SESSION, day).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), *[c.alias(name) for name, c in measures.items()]
    )
    artists = log.where(F.col("artist").isNotNull()).select(USER, SESSION, "artist", day).distinct()
    views = log.groupBy(USER, "page", day).agg(F.count(F.lit(1)).alias("views"))
    return {SESSIONS: sessions, ARTISTS: artists, VIEWS: views}


def update_state(
    spark: SparkSession, lake: str, state: str, start: Moment, end: Moment, ios_pattern: str = ft.IOS_PATTERN
) -> None:
    """Make the state of the days ``[start, end)`` what the lake has now; other days are not read.

    Days of the range that the lake does not have (any more) leave the state. A run that is cut off
    is mended by running it again.
    """
    log = read_lake(spark, lake, start, end)
    for name, rows in day_states(log, ios_pattern).items():
        columns = [column.split()[0] for column in SCHEMAS[name].split(", ")]
        store_days(rows.select(*columns), f"{state}/{name}", lake, start, end)


def read_state(
    spark: SparkSession, state: str, start: Moment | None = None, end: Moment | None = None
) -> dict[str, DataFrame]:
    """The day tables of ``[start, end)``, pruned to these days."""
    return {
        name: in_date_range(spark.read.schema(schema).parquet(f"{state}/{name}"), start, end) for name, schema in SCHEMAS.items()
    }


def features_from_state(
    spark: SparkSession,
    state: str,
    start: Moment | None = None,
    end: Moment | None = None,
    pages: Sequence[str | None] | None = None,
    drop_blank: bool = False,
    max_pages: int = ft.MAX_PAGES,
) -> DataFrame:
    """What :func:`~ebbtide.plans.churn.churn_features` gives for the lake's rows of ``[start, end)``."""
    days = {name: with_user(df, drop_blank) for name, df in read_state(spark, state, start, end).items()}
    sessions = days[SESSIONS].groupBy(USER, SESSION).agg(
        F.max("churn").alias("churn"),
        F.sum("songs").alias("songs"),
        (F.max("last_ts") - F.min("first_ts")).alias("span"),
        F.max("with_artist").alias("with_artist"),
        *[F.max(name).alias(name) for name in FLAG_NAMES],
    )
    artists = days[ARTISTS].select(USER, SESSION, "artist").distinct()
    named = ft.feature_pages(ft.discover_pages(days[VIEWS], max_pages) if pages is None else pages)
    views = ft.views_by_page(days[VIEWS], named, F.sum("views"))
    return with_pages(fused(sessions, artists), views)
