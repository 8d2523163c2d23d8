"""Date-partitioned ORC lake."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ebbtide.functions.filters import Moment, in_date_range
from ebbtide.functions.timestamps import as_day
from ebbtide.schema import LAKE_SCHEMA, PARTITION_COLUMN
from ebbtide.session import Folder


def write_lake(
    df: DataFrame, path: str, stripe_size: int | None = None, rebalance: bool = True
) -> None:
    """Write one directory per UTC date; only dates present in ``df`` are replaced.

    ``rebalance`` gathers each date into well-sized files: adaptive execution splits a large
    date over many tasks and merges small ones, so no task gets a whole hot day. Input that
    already arrives ordered by time can skip that shuffle with ``rebalance=False``.
    """
    columns = [c for c in LAKE_SCHEMA.names if c in df.columns]
    out = df.select(*columns)
    if rebalance:
        out = out.hint("rebalance", PARTITION_COLUMN)
    writer = (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COLUMN)
    )
    if stripe_size:
        writer = writer.option("orc.stripe.size", stripe_size)
    writer.orc(path)


def publish_days(staged: Folder, lake: Folder) -> None:
    """Move each staged day (``date=`` folders) into the lake in place of the one that is there.

    A day is replaced by one delete and one rename; days that were not staged are not touched.
    """
    for day in staged.names(f"{PARTITION_COLUMN}=*"):
        (lake / day).delete()
        (staged / day).move(lake / day)


def publish_batch(staged: Folder, lake: Folder, batch: str) -> None:
    """Add the staged days' files to the lake under names that begin with ``batch``.

    Files of that batch that are there already, from a run that was cut off, go first: a batch that
    is published again leaves the lake as it was.
    """
    for day in lake.names(f"{PARTITION_COLUMN}=*"):
        for name in (lake / day).names(f"{batch}-*"):
            (lake / day / name).delete()
    for day in staged.names(f"{PARTITION_COLUMN}=*"):
        for number, name in enumerate((staged / day).names("part-*")):
            (staged / day / name).move(lake / day / f"{batch}-{number:05}.orc")


def store_days(rows: DataFrame, path: str, lake: str, start: Moment, end: Moment) -> None:
    """Keep ``rows``, derived from the lake's days ``[start, end)``, as a day-partitioned table.

    Days in ``rows`` replace their partitions; days of the range that the lake does not have (any
    more) leave the table.
    """
    folder = Folder(rows.sparkSession, path)
    (
        rows.hint("rebalance", PARTITION_COLUMN)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_COLUMN).parquet(path)
    )
    there = set(Folder(rows.sparkSession, lake).names(f"{PARTITION_COLUMN}=*"))
    for day in folder.names(f"{PARTITION_COLUMN}=*"):
        if day not in there and as_day(start) <= dt.date.fromisoformat(day.partition("=")[2]) < as_day(end):
            (folder / day).delete()


def read_lake(
    spark: SparkSession, path: str, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Scan of ``[start, end)`` as one partition-pruned read.

    Absent days are simply not there; an empty range is an empty frame.
    """
    return in_date_range(spark.read.schema(LAKE_SCHEMA).orc(path), start, end)


def register_views(spark: SparkSession, df: DataFrame, name: str = "api_logs") -> None:
    """Expose the log to SQL."""
    df.createOrReplaceTempView(name)
