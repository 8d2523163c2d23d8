"""Row filters of the exploration panels and of the feature job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.timestamps import as_day, timestamp_literal
from ebbtide.schema import PARTITION_COLUMN

Moment = str | dt.date | dt.datetime


@dataclass(frozen=True)
class LogFilter:
    """Time range (both ends included) and the five multi-select filters.

    ``None`` for a selection means "All": every value, which leaves NULL out just as an
    ``IN`` list does.
    """

    start: Moment | None = None
    end: Moment | None = None
    method: Sequence[str] | None = None
    status: Sequence[int] | None = None
    level: Sequence[str] | None = None
    auth: Sequence[str] | None = None
    page: Sequence[str] | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        df = in_time_range(df, self.start, self.end)
        for name in ("method", "status", "level", "auth", "page"):
            chosen = getattr(self, name)
            column = F.col(name)
            df = df.where(column.isNotNull() if chosen is None else column.isin(list(chosen)))
        return df


def in_time_range(df: DataFrame, start: Moment | None, end: Moment | None) -> DataFrame:
    """``start <= timestamp <= end``; the same range on ``date`` prunes lake partitions."""
    dated = PARTITION_COLUMN in df.columns
    if start is not None:
        df = df.where(F.col("timestamp") >= timestamp_literal(start))
        if dated:
            df = df.where(F.col(PARTITION_COLUMN) >= F.lit(as_day(start)))
    if end is not None:
        df = df.where(F.col("timestamp") <= timestamp_literal(end))
        if dated:
            df = df.where(F.col(PARTITION_COLUMN) <= F.lit(as_day(end)))
    return df


def in_date_range(df: DataFrame, start: Moment | None, end: Moment | None) -> DataFrame:
    """Days from ``start`` (included) to ``end`` (excluded); ``None`` leaves a side open."""
    day = F.col(PARTITION_COLUMN)
    if start is not None:
        df = df.where(day >= F.lit(as_day(start)))
    return df if end is None else df.where(day < F.lit(as_day(end)))


def with_user(df: DataFrame, drop_blank: bool = False) -> DataFrame:
    """Rows with a user id; blank ids stay one user unless ``drop_blank``."""
    df = df.where(F.col("userId").isNotNull())
    return df.where(F.trim("userId") != "") if drop_blank else df
