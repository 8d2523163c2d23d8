"""Churn label and feature families, one row per user each.

A user may hold a large share of the log. Every family therefore aggregates with map-side
combine (first per session where it needs sessions) and no user's rows ever meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.schema import CHURN_PAGES, LEAKAGE_PAGES, SONG_PAGE

USER, SESSION = "userId", "sessionId"
IOS_PATTERN = "%iOS%"

# Flag columns and the patterns behind them, matched case-sensitively.
BROWSER_PATTERNS = {
    "uses_chrome": "%Chrome%",
    "uses_safari": "%Safari%",
    "uses_firefox": "%Firefox%",
    "uses_ie": "%IE%",
}
OS_PATTERNS = {
    "uses_windows": "%Windows%",
    "uses_mac": "%Mac%",
    "uses_ios": IOS_PATTERN,
    "uses_android": "%Android%",
    "uses_linux": "%Linux%",
}
DEVICES = ("mobile", "pc", "tablet")

MAX_PAGES = 10_000

# Columns of the feature frame beside the page counts.
FRAME_COLUMNS = (
    USER,
    "churn",
    "avg_songs_per_session",
    "avg_session_duration_days",
    "avg_num_artists_per_session",
    *BROWSER_PATTERNS,
    *OS_PATTERNS,
    *[name for device in DEVICES for name in (f"uses_{device}", f"uses_non_{device}")],
)


def churn_event() -> Column:
    """1 for a row that marks a churner, else 0."""
    page = F.col("page")
    downgraded, cancelled = (page == CHURN_PAGES[0]), (page == CHURN_PAGES[1])
    return F.when(downgraded | cancelled, 1).otherwise(0)


def days(milliseconds: Column) -> Column:
    return milliseconds / 1000 / 60 / 60 / 24


def session_span() -> Column:
    return F.max("ts") - F.min("ts")


def browser_flags() -> dict[str, Column]:
    family = F.col("userAgent_browser_family")
    return {name: family.like(pattern) for name, pattern in BROWSER_PATTERNS.items()}


def os_flags(ios_pattern: str = IOS_PATTERN) -> dict[str, Column]:
    family = F.col("userAgent_os_family")
    patterns = OS_PATTERNS | {"uses_ios": ios_pattern}
    return {name: family.like(pattern) for name, pattern in patterns.items()}


def device_flags(device: str) -> dict[str, Column]:
    if device not in DEVICES:
        raise ValueError(f"device must be one of {DEVICES}, not {device!r}")
    flag = F.col(f"userAgent_is_{device}")
    return {
        f"uses_{device}": flag == F.lit(True),
        f"uses_non_{device}": flag == F.lit(False),
    }


def any_of(flags: dict[str, Column]) -> list[Column]:
    """Aggregates "any row has the flag" as 0/1, NULL when no row knows."""
    return [F.max(flag).cast("int").alias(name) for name, flag in flags.items()]


def churn_labels(df: DataFrame) -> DataFrame:
    return df.groupBy(USER).agg(F.max(churn_event()).alias("churn"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def discover_pages(df: DataFrame, max_pages: int = MAX_PAGES) -> list[str | None]:
    """Distinct pages, sorted, NULL first.

    A log with more than ``max_pages`` pages raises an error; nothing is ever left out. Pages
    that a caller passes are not bounded.
    """
    rows = df.select("page").distinct().limit(max_pages + 1).collect()
    if len(rows) > max_pages:
        raise ValueError(f"more than {max_pages} distinct pages; pass the pages or raise max_pages")
    return sorted((row.page for row in rows), key=lambda page: (page is not None, page or ""))


def feature_pages(pages: Sequence[str | None]) -> dict[str, str | None]:
    """Output column to page, without the pages that give the label away.

    A column is called like its page, ``null`` for NULL. Names that differ from another column in
    case only, or not at all, get a number, so every page keeps its own count.
    """
    taken = {name.lower() for name in FRAME_COLUMNS}
    named: dict[str, str | None] = {}
    for page in dict.fromkeys(pages):
        if page in LEAKAGE_PAGES:
            continue
        base = name = "null" if page is None else page
        number = 2
        while name.lower() in taken:
            name, number = f"{base} ({number})", number + 1
        taken.add(name.lower())
        named[name] = page
    return named


def page_column(column: Column, name: str, page: str | None) -> Column:
    """``column`` under ``name``; the page itself travels as metadata, also through Parquet."""
    return column.alias(name, metadata={"page": page, "is_page": True})


def page_views(
    df: DataFrame, pages: Sequence[str | None] | None = None, max_pages: int = MAX_PAGES
) -> DataFrame:
    """Views per user and page; ``pages`` spares the discovery pass over the log.

    Counted by user and page and turned round afterwards: one plan for any number of pages. The
    broadcast list holds the wanted pages only.
    """
    named = feature_pages(discover_pages(df, max_pages) if pages is None else pages)
    return views_by_page(df, named, F.count(F.lit(1)))


def views_by_page(df: DataFrame, named: dict[str, str | None], views: Column) -> DataFrame:
    """``views`` per user and page of ``named``, turned round to one row per user."""
    if not named:
        return df.select(USER).distinct()
    wanted = df.sparkSession.createDataFrame(
        list(zip(range(len(named)), named.values())), "place int, wanted string"
    )
    known = df.join(
        F.broadcast(wanted), F.col("page").eqNullSafe(F.col("wanted")), "left"
    )
    counts = known.groupBy(USER).pivot("place", list(range(len(named)))).agg(views)
    return counts.select(
        USER,
        *[
            page_column(F.coalesce(quoted(str(place)), F.lit(0)), name, page)
            for place, (name, page) in enumerate(named.items())
        ],
    )


def avg_songs_per_session(df: DataFrame) -> DataFrame:
    """Mean songs over the sessions that have songs."""
    songs = df.where(F.col("page") == SONG_PAGE).groupBy(USER, SESSION).agg(F.count("*").alias("n"))
    return songs.groupBy(USER).agg(F.avg("n").alias("avg_songs_per_session"))


def avg_session_duration(df: DataFrame) -> DataFrame:
    """Mean time from first to last row over all sessions, in days.

    Whole milliseconds are averaged and scaled afterwards: their sums are exact, so the
    result does not depend on the layout of the data.
    """
    spans = df.groupBy(USER, SESSION).agg(session_span().alias("span"))
    return spans.groupBy(USER).agg(days(F.avg("span")).alias("avg_session_duration_days"))


def avg_artists_per_session(df: DataFrame) -> DataFrame:
    """Mean distinct artists over the sessions that have artists."""
    heard = df.where(F.col("artist").isNotNull())
    artists = heard.groupBy(USER, SESSION).agg(F.count_distinct("artist").alias("n"))
    return artists.groupBy(USER).agg(F.avg("n").alias("avg_num_artists_per_session"))


def browser_usage(df: DataFrame) -> DataFrame:
    return df.groupBy(USER).agg(*any_of(browser_flags()))


def os_usage(df: DataFrame, ios_pattern: str = IOS_PATTERN) -> DataFrame:
    return df.groupBy(USER).agg(*any_of(os_flags(ios_pattern)))


def device_usage(df: DataFrame, device: str) -> DataFrame:
    return df.groupBy(USER).agg(*any_of(device_flags(device)))


def dataset_summary(df: DataFrame) -> DataFrame:
    """Row, user and churner counts in one pass over one row per user."""
    users = df.groupBy(USER).agg(F.count(F.lit(1)).alias("n"), F.max(churn_event()).alias("churn"))
    known = F.col(USER).isNotNull()
    return users.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("messages"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("messages_with_user"),
        F.count(USER).alias("users"),
        F.count_if(known & (F.col("churn") > 0)).alias("churned_users"),
        F.count_if(known & (F.col("churn") == 0)).alias("loyal_users"),
    )
