"""The churn feature frame: every family, one row per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.filters import with_user
from ebbtide.operators import features as ft
from ebbtide.operators.features import SESSION, USER
from ebbtide.schema import SONG_PAGE


FLAG_NAMES = (
    *ft.BROWSER_PATTERNS,
    *ft.OS_PATTERNS,
    *[name for device in ft.DEVICES for name in (f"uses_{device}", f"uses_non_{device}")],
)


def churn_features(
    df: DataFrame,
    pages: Sequence[str | None] | None = None,
    ios_pattern: str = ft.IOS_PATTERN,
    drop_blank: bool = False,
    max_pages: int = ft.MAX_PAGES,
) -> DataFrame:
    """Label and features fused into two aggregation levels.

    Sessions are summed up first, next to the distinct artists of each session, and both
    meet in one aggregation per user. The wide aggregates thus shuffle one row per session;
    only the three narrow columns of the artist count shuffle at song grain. Pages are counted
    by key and joined, one row per user on both sides, whatever their number.
    """
    df = with_user(df, drop_blank)
    sessions = df.groupBy(USER, SESSION).agg(
        *[column.alias(name) for name, column in session_measures(ios_pattern).items()]
    )
    artists = df.where(F.col("artist").isNotNull()).select(USER, SESSION, "artist").distinct()
    return with_pages(fused(sessions, artists), ft.page_views(df, pages, max_pages))


def session_measures(ios_pattern: str = ft.IOS_PATTERN) -> dict[str, Column]:
    """The aggregates of a session, by name."""
    flags = ft.browser_flags() | ft.os_flags(ios_pattern)
    for device in ft.DEVICES:
        flags |= ft.device_flags(device)
    return {
        "churn": F.max(ft.churn_event()),
        "songs": F.count_if(F.col("page") == SONG_PAGE),
        "span": ft.session_span(),
        "with_artist": F.max(F.col("artist").isNotNull().cast("int")),
    } | {name: F.max(flag).cast("int") for name, flag in flags.items()}


def fused(sessions: DataFrame, artists: DataFrame) -> DataFrame:
    """One row per user from sessions (:func:`session_measures`) and distinct artists of sessions."""
    heard = artists.select(USER, F.lit(1).cast("bigint").alias("artists"))
    both = sessions.drop(SESSION).unionByName(heard, allowMissingColumns=True)
    return both.groupBy(USER).agg(
        F.max("churn").alias("churn"),
        F.coalesce(F.avg(F.nullif("songs", F.lit(0))), F.lit(0.0)).alias("avg_songs_per_session"),
        F.coalesce(ft.days(F.avg("span")), F.lit(0.0)).alias("avg_session_duration_days"),
        F.coalesce(
            F.try_divide(F.sum("artists").cast("double"), F.sum("with_artist")), F.lit(0.0)
        ).alias("avg_num_artists_per_session"),
        *[F.coalesce(F.max(name), F.lit(0)).alias(name) for name in FLAG_NAMES],
    )


def with_pages(frame: DataFrame, views: DataFrame) -> DataFrame:
    """``frame`` with the page counts of the same users after its first two columns."""
    first, rest = frame.columns[:2], frame.columns[2:]
    pages = [F.col(ft.quoted(name)) for name in views.drop(USER).columns]
    return frame.join(views, USER).select(*first, *pages, *rest)


def join_families(labels: DataFrame, families: Sequence[DataFrame]) -> DataFrame:
    """Left join of feature frames on the user key.

    Every side has one row per user and comes hash-partitioned by it, so the joins add no
    shuffle of their own.
    """
    out = labels
    for family in families:
        out = out.join(family, [USER], "left")
    return out.fillna(0)


def churn_features_joined(
    df: DataFrame,
    pages: Sequence[str | None] | None = None,
    ios_pattern: str = ft.IOS_PATTERN,
    drop_blank: bool = False,
    max_pages: int = ft.MAX_PAGES,
) -> DataFrame:
    """The same frame put together from the single families."""
    df = with_user(df, drop_blank)
    families = join_families(
        ft.churn_labels(df),
        [
            ft.avg_songs_per_session(df),
            ft.avg_session_duration(df),
            ft.avg_artists_per_session(df),
            ft.browser_usage(df),
            ft.os_usage(df, ios_pattern),
            *[ft.device_usage(df, device) for device in ft.DEVICES],
        ],
    )
    return with_pages(families, ft.page_views(df, pages, max_pages))
