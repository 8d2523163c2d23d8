"""Exploration operators: distinct values, value counts, time-bucketed counts.

Every count is a plain ``groupBy`` with map-side combine, so a value that holds a third of
all rows reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions.filters import LogFilter
from ebbtide.functions.timestamps import time_bucket, utc_day

# Panel dimensions and the log columns behind them.
DIMENSIONS = {
    "method": "method",
    "auth": "auth",
    "page": "page",
    "status": "status",
    "gender": "gender",
    "level": "level",
    "browser": "userAgent_browser_family",
    "os": "userAgent_os_family",
}

# Columns of the value overview.
OVERVIEW = {
    "method": "method",
    "user_agent": "userAgent",
    "os": "userAgent_os_family",
    "page": "page",
    "status": "status",
    "auth": "auth",
    "browser": "userAgent_browser_family",
    "gender": "gender",
}

# Columns that offer a sorted list of choices.
VARIABLES = ("method", "status", "level", "auth", "page")

MAX_SLICES = 50
SERIES_PAGES = ("Submit Downgrade", "Submit Upgrade")


def dimension(name: str) -> Column:
    if name not in DIMENSIONS:
        raise ValueError(f"dimension must be one of {list(DIMENSIONS)}, not {name!r}")
    return F.col(DIMENSIONS[name]).cast("string")


def distinct_values(df: DataFrame, column: str, ordered: bool = False) -> DataFrame:
    """Distinct values of a column; NULL is a value and sorts last."""
    values = df.select(column).distinct()
    return values.orderBy(F.col(column).asc_nulls_last()) if ordered else values


def with_share(counts: DataFrame, *group: str) -> DataFrame:
    """Add each value's percentage of its group.

    The window runs over counted rows, one per value of a small vocabulary, never over the log.
    """
    total = F.sum("value").over(Window.partitionBy(*group))
    return counts.withColumn("percent", F.col("value").cast("double") * 100 / total)


def value_counts(
    df: DataFrame,
    dim: str,
    filters: LogFilter = LogFilter(),
    limit: int | None = None,
    snapshot: bool = False,
) -> DataFrame:
    """``(metric, value, percent)`` of one dimension under the panel filters.

    ``limit`` keeps the largest slices (ties by name); ``snapshot`` adds the time of the query.
    """
    counts = (
        filters.apply(df)
        .groupBy(dimension(dim).alias("metric"))
        .agg(F.count(F.lit(1)).alias("value"))
    )
    shares = with_share(counts)
    if limit is not None:
        shares = shares.orderBy(F.desc("value"), F.col("metric").asc_nulls_last()).limit(limit)
    return shares.withColumn("time", F.current_timestamp()) if snapshot else shares


def top_pages(df: DataFrame, filters: LogFilter = LogFilter(), limit: int = MAX_SLICES) -> DataFrame:
    return value_counts(df, "page", filters, limit=limit)


def time_counts(
    df: DataFrame, dim: str, interval: str = "1d", filters: LogFilter = LogFilter()
) -> DataFrame:
    """``(time, metric, value)`` per epoch-aligned bucket, ordered by time."""
    return (
        filters.apply(df)
        .groupBy(
            time_bucket(F.col("timestamp"), interval).alias("time"), dimension(dim).alias("metric")
        )
        .agg(F.count(F.lit(1)).alias("value"))
        .orderBy("time", F.col("metric").asc_nulls_last())
    )


def free_vs_paid(df: DataFrame, interval: str = "1d", filters: LogFilter = LogFilter()) -> DataFrame:
    return time_counts(df, "level", interval, filters)


def downgrades_vs_upgrades(
    df: DataFrame,
    interval: str = "1d",
    pages: Sequence[str] = SERIES_PAGES,
    filters: LogFilter = LogFilter(),
) -> DataFrame:
    """Series of ``pages``; the panel's own page selection narrows them further."""
    chosen = [page for page in pages if filters.page is None or page in filters.page]
    return time_counts(df, "page", interval, replace(filters, page=chosen))


def weekday_counts(df: DataFrame, filters: LogFilter = LogFilter()) -> DataFrame:
    """``(weekday, value)``, 1 is Sunday; days are UTC in any session zone."""
    return (
        filters.apply(df)
        .groupBy(F.dayofweek(utc_day(F.col("timestamp"))).alias("weekday"))
        .agg(F.count(F.lit(1)).alias("value"))
    )


def combinations(df: DataFrame, *extra: Column) -> DataFrame:
    """Rows counted per combination of all panel dimensions, as ``n``.

    The log is read and shuffled once for a whole dashboard; the panels are then cut from
    these counts, of which there are as many as combinations occur.
    """
    dims = [dimension(name).alias(name) for name in DIMENSIONS]
    return df.groupBy(*extra, *dims).agg(F.count(F.lit(1)).alias("n"))


def panels(counts: DataFrame, *extra: str) -> DataFrame:
    """``(panel, metric, value)`` of every dimension, from rows that stand for ``n`` log rows each."""
    pairs = F.array(*[F.struct(F.lit(n).alias("panel"), F.col(n).alias("metric")) for n in DIMENSIONS])
    return (
        counts.select(*extra, "n", F.explode(pairs).alias("p"))
        .groupBy(*extra, F.col("p.panel").alias("panel"), F.col("p.metric").alias("metric"))
        .agg(F.sum("n").alias("value"))
    )


def value_distribution(
    df: DataFrame, filters: LogFilter = LogFilter(), limits: dict[str, int] | None = None
) -> DataFrame:
    """All eight value-count panels from one scan: ``(panel, metric, value, percent)``.

    ``limits`` keeps the largest slices of a panel (ties by name), such as
    ``{"page": 50, "level": 50}``; shares stay shares of all rows.
    """
    shares = with_share(panels(combinations(filters.apply(df))), "panel")
    if not limits:
        return shares
    order = Window.partitionBy("panel").orderBy(F.desc("value"), F.col("metric").asc_nulls_last())
    limit = F.coalesce(*[F.when(F.col("panel") == name, n) for name, n in limits.items()])
    ranked = shares.withColumn("rank", F.row_number().over(order)).withColumn("limit", limit)
    return ranked.where("limit IS NULL OR rank <= limit").drop("rank", "limit")


def time_distribution(
    df: DataFrame, interval: str = "1d", filters: LogFilter = LogFilter()
) -> DataFrame:
    """All eight time series from one scan: ``(time, panel, metric, value)``."""
    time = time_bucket(F.col("timestamp"), interval).alias("time")
    return panels(combinations(filters.apply(df), time), "time").orderBy(
        "time", "panel", F.col("metric").asc_nulls_last()
    )


def status_drilldown(
    df: DataFrame, status: int = 404, filters: LogFilter = LogFilter()
) -> DataFrame:
    """Every value-count panel for one HTTP status."""
    return value_distribution(df.where(F.col("status") == status), filters)
