"""JSON-lines log source with quarantine of unusable lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.timestamps import timestamp_from_ms
from ebbtide.schema import CORRUPT_COLUMN, RAW_SCHEMA

LINE_COLUMN = "_line"
JSON_SCHEMA = T.StructType(RAW_SCHEMA.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def parse_lines(lines: DataFrame) -> DataFrame:
    """Text lines (``value``) as the raw fields, ``_corrupt_record`` and the line itself.

    Absent fields are NULL, extra keys are ignored. The schema is never inferred, which would
    cost a pass over the whole input. Blank lines are skipped.
    """
    parsed = F.from_json("value", JSON_SCHEMA, JSON_OPTIONS)
    kept = lines.where(F.trim("value") != "")
    return kept.select(parsed.alias("r"), F.col("value").alias(LINE_COLUMN)).select("r.*", LINE_COLUMN)


def read_log_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One JSON object per line."""
    return parse_lines(spark.read.text(path))


def any_field() -> Column:
    """Some field as text, NULL if there is none; text fields first, which need no cast."""
    fields = sorted(RAW_SCHEMA.fields, key=lambda f: (f.dataType != T.StringType(), f.name != "page"))
    return F.coalesce(*[F.col(f.name).cast("string") for f in fields])


def bad_reason(df: DataFrame) -> Column:
    """Why a line cannot be used, NULL for a good one.

    The reader judges only the fields it is asked for, so the test for empty lines, which
    looks at every field, also keeps the verdict the same whatever columns are used later.
    """
    malformed = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in df.columns else F.lit(False)
    bad_registration = (
        F.col("registration").isNotNull() & timestamp_from_ms(F.col("registration")).isNull()
    )
    return (
        F.when(malformed, "malformed")
        .when(any_field().isNull(), "empty")
        .when(F.col("ts").isNull(), "missing ts")
        .when(timestamp_from_ms(F.col("ts")).isNull(), "unusable ts")
        .when(bad_registration, "unusable registration")
    )


def good_records(df: DataFrame) -> DataFrame:
    return df.where(bad_reason(df).isNull()).drop(CORRUPT_COLUMN, LINE_COLUMN)


def bad_records(df: DataFrame) -> DataFrame:
    """``(line, reason)``: the line as it was read, so that it can be mended and replayed."""
    bad = df.withColumn("reason", bad_reason(df)).where(F.col("reason").isNotNull())
    return bad.select(F.col(LINE_COLUMN).alias("line"), "reason")


def judged(df: DataFrame) -> DataFrame:
    """All rows, with ``reason`` (NULL for a good one) and ``line`` (for a bad one only)."""
    reason = bad_reason(df)
    return df.withColumns({"reason": reason, "line": F.when(reason.isNotNull(), F.col(LINE_COLUMN))}).drop(
        CORRUPT_COLUMN, LINE_COLUMN
    )


def split_bad_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): malformed lines and lines without a usable time go to bad."""
    return good_records(df), bad_records(df)
