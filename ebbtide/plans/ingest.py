"""Batch ingest: JSON lines to the enriched, date-partitioned lake."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.timestamps import with_timestamps
from ebbtide.functions.user_agent import with_user_agent
from ebbtide.schema import LAKE_SCHEMA, PARTITION_COLUMN
from ebbtide.session import Folder
from ebbtide.sources.json_log import good_records, judged, read_log_json
from ebbtide.sources.lake import publish_days, write_lake

BAD = "bad"


def enrich(raw: DataFrame) -> DataFrame:
    """Raw rows to log rows: pure column work, no shuffle."""
    return with_user_agent(with_timestamps(raw))


def stage(lines: DataFrame, path: str, stripe_size: int | None = None) -> None:
    """Parse ``lines`` once and write good and bad ones apart under ``path``, in one job.

    ``bad=false/date=...`` holds lake rows, ``bad=true`` lines with their reason. Each day is gathered
    into well-sized files, as by :func:`write_lake`.
    """
    rows = enrich(judged(lines)).withColumn(BAD, F.col("reason").isNotNull())
    columns = [c for c in LAKE_SCHEMA.names if c != PARTITION_COLUMN]
    day = F.when(~F.col(BAD), F.col(PARTITION_COLUMN)).alias(PARTITION_COLUMN)
    writer = rows.select(*columns, "line", "reason", BAD, day).hint("rebalance", BAD, PARTITION_COLUMN)
    writer = writer.write.mode("overwrite").partitionBy(BAD, PARTITION_COLUMN)
    if stripe_size:
        writer = writer.option("orc.stripe.size", stripe_size)
    writer.orc(path)


def staged_bad(spark: SparkSession, path: str) -> DataFrame:
    """``(line, reason)`` of what :func:`stage` set apart."""
    found = spark.read.schema(f"line string, reason string, {PARTITION_COLUMN} date").orc(f"{path}/{BAD}=true")
    return found.select("line", "reason")


def ingest(
    spark: SparkSession,
    source: str | list[str],
    lake: str,
    quarantine: str | None = None,
    stripe_size: int | None = None,
    rebalance: bool = True,
) -> int | None:
    """Write good lines to ``lake``; with ``quarantine`` also the bad ones, with their reason.

    The input is read and parsed once. With a quarantine one job writes good and bad lines apart
    into a hidden folder of the lake; the bad ones (alone) are then written as JSON lines to a ``run=`` folder
    of their own, their number is returned, and the days are published by renaming. A run that is
    cut off before leaves the lake as it was; one that is cut off while publishing leaves every day
    old or new, and a repeated run replaces them all.
    """
    lines = read_log_json(spark, source)
    if quarantine is None:
        write_lake(enrich(good_records(lines)), lake, stripe_size, rebalance)
        return None
    run = uuid.uuid4().hex
    staged = Folder(spark, lake) / f"_staged-{run}"
    try:
        stage(lines, str(staged), stripe_size)
        bad = 0
        if (staged / f"{BAD}=true").exists():
            found = staged_bad(spark, str(staged))
            bad = found.count()  # from the files' footers
            found.write.json(f"{quarantine.rstrip('/')}/run={run}")
        publish_days(staged / f"{BAD}=false", Folder(spark, lake))
        return bad
    finally:
        staged.delete()
