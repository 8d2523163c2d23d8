"""Distinct users of any range of days and any panel value, without the log.

Per day of the lake and value of the kept columns a HyperLogLog sketch of the user ids is stored (Spark's own
``hll_sketch_agg``). Sketches merge in any order and over any days: a user of many days, or of several values,
counts once, which sums of daily counts cannot give. A sketch has a fixed size (at most ``2 ** LG_K`` bytes) and is built in
part in each task, so neither a hot user nor a hot day makes a large row or a large task.

The estimate of merged sketches has a relative standard error of ``1.04 / sqrt(2 ** LG_K)``, 0.81 %;
:data:`ERROR_BOUND` is three of them. :func:`~ebbtide.operators.features.dataset_summary` stays exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.filters import Moment, in_date_range, with_user
from ebbtide.operators.features import USER
from ebbtide.schema import LAKE_SCHEMA, PARTITION_COLUMN
from ebbtide.sources.lake import read_lake, store_days

LG_K = 14
ERROR_BOUND = 3 * 1.04 / 2 ** (LG_K / 2)
KEPT = ("level",)


def day_sketches(log: DataFrame, kept: Sequence[str] = KEPT) -> DataFrame:
    """``(kept columns, rows, users, date)``: row count and user sketch of the days in ``log``.

    Rows without a user belong to no sketch; a day or value of which only such rows exist has no row.
    Blank ids are one user, as in the features: sketches skip empty strings, hence the prefix.
    """
    return with_user(log).groupBy(*kept, PARTITION_COLUMN).agg(
        F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg(F.concat(F.lit("u"), USER), LG_K).alias("users")
    ).select(*kept, "rows", "users", PARTITION_COLUMN)


def update_audience(
    spark: SparkSession, lake: str, store: str, start: Moment, end: Moment, kept: Sequence[str] = KEPT
) -> None:
    """Make the sketches of the days ``[start, end)`` what the lake has now; other days are not read."""
    store_days(day_sketches(read_lake(spark, lake, start, end), kept), store, lake, start, end)


def read_audience(
    spark: SparkSession, store: str, start: Moment | None = None, end: Moment | None = None, kept: Sequence[str] = KEPT
) -> DataFrame:
    """The stored sketches of the days ``[start, end)``."""
    types = [f"`{name}` {LAKE_SCHEMA[name].dataType.simpleString()}" for name in kept]
    schema = ", ".join([*types, "rows bigint", "users binary", f"{PARTITION_COLUMN} date"])
    return in_date_range(spark.read.schema(schema).parquet(store), start, end)


def users(sketches: DataFrame, *by: str) -> DataFrame:
    """``(by, rows, users)``: log rows and estimated distinct users per value of ``by`` (any of the kept
    columns and ``date``; all in one row without)."""
    return sketches.groupBy(*by).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0)).alias("users"),
    )
