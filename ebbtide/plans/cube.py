"""Panel counts by day: every panel, filter and bucket width from one small table instead of the log.

The cube holds, per day of the lake, the number of rows for each five minutes and each combination of the
panel columns that occurs in them. It is stored by ``date``; a nightly run reads the new days of the log and
nothing else of it. Its rows look like log rows that stand for ``n`` rows each, with the start of the five
minutes as ``timestamp``, so the panel filters apply to them as they are. All other widths are multiples of
five minutes and every bucket starts at a multiple of its width since 1970: they are rolled up.

A time range that cuts a five-minute bucket is answered exactly: the whole buckets come from the cube, the
rows of the (at most two) cut ones from the lake.

The size of a day depends on the combinations, not on the rows: a busy day has at most 288 times as many cube
rows as combinations. Counts combine in the tasks before they are shuffled, so a value that holds a third of
all rows is one partial row a task. Rows without timestamp belong to no bucket, as in the panels.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.filters import LogFilter, Moment
from ebbtide.functions.timestamps import INTERVALS, as_utc, time_bucket
from ebbtide.operators.explore import DIMENSIONS, dimension, panels, with_share
from ebbtide.schema import LAKE_SCHEMA, PARTITION_COLUMN
from ebbtide.sources.lake import read_lake, store_days

BASE, BASE_WIDTH = "5m", dt.timedelta(minutes=5)
TICK = dt.timedelta(microseconds=1)
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.UTC)
COLUMNS = list(DIMENSIONS.values())
SCHEMA = (
    "timestamp timestamp, "
    + ", ".join(f"`{name}` {LAKE_SCHEMA[name].dataType.simpleString()}" for name in COLUMNS)
    + f", n bigint, {PARTITION_COLUMN} date"
)


def base_counts(log: DataFrame) -> DataFrame:
    """The cube's rows for the days in ``log``."""
    start = time_bucket(F.col("timestamp"), BASE).alias("timestamp")
    counts = log.groupBy(start, *COLUMNS, PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("timestamp", *COLUMNS, "n", PARTITION_COLUMN)


def update_cube(spark: SparkSession, lake: str, cube: str, start: Moment, end: Moment) -> None:
    """Make the cube's days ``[start, end)`` what the lake has now; other days are not read.

    Days of the range that the lake does not have (any more) leave the cube. A run that is cut off is
    mended by running it again.
    """
    store_days(base_counts(read_lake(spark, lake, start, end)), cube, lake, start, end)


def _whole_buckets(filters: LogFilter) -> tuple[dt.datetime | None, dt.datetime | None]:
    """First bucket start and end (excluded) of the whole buckets in the range; ``None`` is open."""
    first = last = None
    if filters.start is not None:
        first = EPOCH - (EPOCH - as_utc(filters.start)) // BASE_WIDTH * BASE_WIDTH
    if filters.end is not None:
        last = EPOCH + (as_utc(filters.end) + TICK - EPOCH) // BASE_WIDTH * BASE_WIDTH
    return first, last


def cube_rows(spark: SparkSession, lake: str, cube: str, filters: LogFilter = LogFilter()) -> DataFrame:
    """``(timestamp, panel columns, n)`` of the rows that pass the filters; sums of ``n`` are exact."""
    first, last = _whole_buckets(filters)
    stored = spark.read.schema(SCHEMA).parquet(cube)
    log = read_lake(spark, lake)

    def from_log(start: Moment | None, end: Moment | None) -> DataFrame:
        return base_counts(replace(filters, start=start, end=end).apply(log)).drop(PARTITION_COLUMN)

    if first is not None and last is not None and first >= last:
        return from_log(filters.start, filters.end)
    whole = replace(filters, start=first, end=None if last is None else last - TICK)
    rows = whole.apply(stored).drop(PARTITION_COLUMN)
    if first is not None and as_utc(filters.start) < first:
        rows = rows.unionByName(from_log(filters.start, first - TICK))
    if last is not None and last <= as_utc(filters.end):
        rows = rows.unionByName(from_log(last, filters.end))
    return rows


def value_counts(rows: DataFrame, dim: str) -> DataFrame:
    """``(metric, value, percent)`` of one dimension, as of the log."""
    return with_share(rows.groupBy(dimension(dim).alias("metric")).agg(F.sum("n").alias("value")))


def value_distribution(rows: DataFrame) -> DataFrame:
    """All eight value-count panels: ``(panel, metric, value, percent)``."""
    return with_share(panels(_named(rows)), "panel")


def time_counts(rows: DataFrame, dim: str, interval: str = "1d") -> DataFrame:
    """``(time, metric, value)`` of one dimension in any width, ordered by time."""
    time = time_bucket(F.col("timestamp"), interval).alias("time")
    counts = rows.groupBy(time, dimension(dim).alias("metric")).agg(F.sum("n").alias("value"))
    return counts.orderBy("time", F.col("metric").asc_nulls_last())


def time_resolutions(rows: DataFrame, intervals: Sequence[str] = tuple(INTERVALS)) -> DataFrame:
    """All eight time series in all the widths: ``(interval, time, panel, metric, value)``.

    One pass over the cube: the panels are cut first, then grouping sets count each width.
    """
    wide = panels(_named(rows, "timestamp"), "timestamp")
    for interval in intervals:  # one at a time: a projection takes a single window
        wide = wide.withColumn(interval, time_bucket(F.col("timestamp"), interval))
    starts = [F.col(f"`{interval}`") for interval in intervals]
    sets = [[start, "panel", "metric"] for start in starts]
    counts = wide.groupingSets(sets, *starts, "panel", "metric").agg(F.sum("value").alias("value"))
    # A row belongs to the one width whose start it has: no row is without a time.
    named = [F.when(start.isNotNull(), F.lit(interval)) for interval, start in zip(intervals, starts)]
    return counts.select(
        F.coalesce(*named).alias("interval"), F.coalesce(*starts).alias("time"), "panel", "metric", "value"
    )


def _named(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, "n", *[dimension(name).alias(name) for name in DIMENSIONS])
