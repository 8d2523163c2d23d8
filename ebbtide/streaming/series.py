"""Time-bucketed counts over a stream, with state that ends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ebbtide.functions.filters import LogFilter
from ebbtide.functions.timestamps import INTERVALS
from ebbtide.operators.explore import dimension
from ebbtide.session import Folder

DELAY = dt.timedelta(days=1)
COUNTS = "time timestamp, metric string, value bigint"
#: The parts that a batch writes: buckets that the watermark has passed, rows that came after it had
#: passed their bucket, and the buckets that may still grow. The mark closes a batch.
CLOSED, LATE, OPEN, MARK = "closed", "late", "open", "mark"


def time_rows(log: DataFrame, dim: str, interval: str = "1d", filters: LogFilter = LogFilter()) -> DataFrame:
    """Rows of a stream (or a table) as bucket, its end, metric and timestamp."""
    if interval not in INTERVALS:
        raise ValueError(f"interval must be one of {list(INTERVALS)}, not {interval!r}")
    return filters.apply(log).select(
        F.window("timestamp", INTERVALS[interval]).alias("bucket"), dimension(dim).alias("metric"), "timestamp"
    ).select(F.col("bucket.start").alias("time"), F.col("bucket.end").alias("ends"), "metric", "timestamp")


def _part(out: Folder, batch: int) -> Folder:
    return out / f"batch={batch:09}"


def _moment(micros: int | None) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def _last(spark: SparkSession, out: Folder, before: int) -> tuple[int | None, int | None]:
    """The last batch below ``before`` that was closed, and its watermark in microseconds."""
    for name in reversed(out.names("batch=*")):
        batch = int(name.removeprefix("batch="))
        if batch < before and (out / name / MARK / "_SUCCESS").exists():
            found = spark.read.schema("watermark bigint").parquet(str(out / name / MARK)).first()
            return batch, found["watermark"]
    return None, None


def count_stream(
    rows: DataFrame, out: str, checkpoint: str, delay: dt.timedelta = DELAY
) -> StreamingQuery:
    """Count the new rows of :func:`time_rows` into the folder ``out``, then stop.

    The watermark is the latest timestamp of the batches before, less ``delay``. A bucket that the
    watermark has passed is closed: its counts are appended once and leave the state, so the state
    (``open``) holds the buckets of the last ``delay`` only, however long the stream runs. A row whose
    bucket is closed already is late; late rows are counted per batch in a part of their own and
    :func:`counts_so_far` adds them, so no row is lost. Every part belongs to a batch and is replaced
    if Spark runs that batch again; its mark is written last, and a batch without mark does not count.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        folder = Folder(spark, out)
        here = _part(folder, number)
        here.delete()
        last, watermark = _last(spark, folder, number)
        # One pass over the batch; from here on all is bucket by bucket.
        fresh = batch.groupBy("time", "ends", "metric").agg(F.count(F.lit(1)).alias("value"), F.max("timestamp").alias("newest"))
        counted = _written(fresh, here / "counted")
        newest = counted.agg(F.unix_micros(F.max("newest")).alias("newest")).first()["newest"]
        late = F.coalesce(F.col("ends") <= _moment(watermark), F.lit(False))
        _written(counted.where(late).select("time", "metric", "value"), here / LATE)
        held = counted.where(~late).select("time", "ends", "metric", "value")
        if last is not None:
            held = held.unionByName(spark.read.schema(held.schema).parquet(str(_part(folder, last) / OPEN)))
        held = held.groupBy("time", "ends", "metric").agg(F.sum("value").alias("value"))
        moved = [m for m in (watermark, None if newest is None else newest - delay // dt.timedelta(microseconds=1)) if m is not None]
        watermark = max(moved) if moved else None
        over = F.coalesce(F.col("ends") <= _moment(watermark), F.lit(False))
        held = _written(held.withColumn("over", over), here / "held")
        _written(held.where("over").select("time", "metric", "value"), here / CLOSED)
        _written(held.where("not over").drop("over"), here / OPEN)
        _written(spark.range(1).select(F.lit(watermark).cast("bigint").alias("watermark")), here / MARK)
        for name in ("counted", "held"):
            (here / name).delete()
        if last is not None:  # a batch needs the state of the one before only
            for name in folder.names("batch=*"):
                if int(name.removeprefix("batch=")) < last:
                    (folder / name / OPEN).delete()

    return (
        rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _written(df: DataFrame, to: Folder) -> DataFrame:
    df.write.mode("overwrite").parquet(str(to))
    return df.sparkSession.read.schema(df.schema).parquet(str(to))


def _parts(spark: SparkSession, out: str, kind: str) -> DataFrame:
    last, _ = _last(spark, Folder(spark, out), 1 << 62)
    if last is None:
        return spark.createDataFrame([], COUNTS)
    folder = Folder(spark, out)
    batches = [name for name in folder.names("batch=*") if int(name.removeprefix("batch=")) <= last]
    paths = [str(folder / name / kind) for name in batches if (folder / name / kind).exists()]
    if kind == OPEN:
        paths = paths[-1:]
    return spark.read.schema(COUNTS).parquet(*paths)


def closed_counts(spark: SparkSession, out: str) -> DataFrame:
    """Append output: buckets that the watermark has passed, without late rows."""
    return _parts(spark, out, CLOSED)


def late_counts(spark: SparkSession, out: str) -> DataFrame:
    """Rows that came after their bucket was closed, counted."""
    return _parts(spark, out, LATE)


def open_counts(spark: SparkSession, out: str) -> DataFrame:
    """The state: buckets that may still grow."""
    return _parts(spark, out, OPEN)


def counts_so_far(spark: SparkSession, out: str) -> DataFrame:
    """``(time, metric, value)`` of every bucket, late rows included: what a batch run would count."""
    parts = closed_counts(spark, out).unionByName(late_counts(spark, out)).unionByName(open_counts(spark, out))
    return parts.groupBy("time", "metric").agg(F.sum("value").alias("value"))
