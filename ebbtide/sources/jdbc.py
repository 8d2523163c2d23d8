"""Export of the enriched log to a relational serving table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.schema import LOG_SCHEMA

# Fixed value: rows of one insert batch.
BATCH_SIZE = 5000

# Text widths of the serving table; all other text columns are unbounded.
VARCHAR_WIDTHS = {
    "userId": 50,
    "userAgent": 150,
    "userAgent_browser_family": 50,
    "userAgent_browser_version": 15,
    "userAgent_os_family": 50,
    "userAgent_os_version": 15,
    "userAgent_is_mobile": 50,
    "userAgent_is_pc": 50,
    "userAgent_is_tablet": 50,
    "lastName": 50,
    "method": 10,
    "level": 10,
    "firstName": 50,
    "auth": 50,
    "gender": 1,
}

# Numeric columns the serving table keeps as decimals.
DECIMALS = {
    "sessionId": "decimal(20,0)",
    "status": "decimal(20,0)",
    "itemInSession": "decimal(20,0)",
    "registration": "decimal(20,3)",
    "ts": "decimal(20,3)",
}

FLAGS = ("userAgent_is_mobile", "userAgent_is_pc", "userAgent_is_tablet")


def column_types() -> str:
    """Target types for the table Spark creates when it is absent."""
    return ", ".join(f"{name} VARCHAR({width})" for name, width in VARCHAR_WIDTHS.items())


def serving_columns(df: DataFrame) -> DataFrame:
    """The 27 log columns with the types of the serving table."""
    casts = DECIMALS | dict.fromkeys(FLAGS, "string")
    return df.select(
        *[
            F.col(name).cast(casts[name]).alias(name) if name in casts else F.col(name)
            for name in LOG_SCHEMA.names
        ]
    )


def too_wide(widths: dict[str, int] = VARCHAR_WIDTHS) -> Column:
    """The first column whose value is longer than the serving table takes, or NULL."""
    cases = [F.when(F.length(F.col(name).cast("string")) > width, name) for name, width in widths.items()]
    return F.coalesce(*cases)


def fitting(df: DataFrame, widths: dict[str, int] = VARCHAR_WIDTHS) -> tuple[DataFrame, DataFrame]:
    """(rows that fit, rows to set aside with the ``column`` that is too wide); nothing is cut."""
    rows = serving_columns(df)
    wide = rows.withColumn("column", too_wide(widths)).where(F.col("column").isNotNull())
    return rows.where(too_wide(widths).isNull()), wide


def export_rows(df: DataFrame, connections: int = 16) -> DataFrame:
    """The rows to append, dealt out over ``connections`` tasks by a shuffle, so that the scan and
    the enrichment before it keep their own parallelism."""
    return fitting(df)[0].repartition(connections)


def export_jdbc(
    df: DataFrame,
    url: str,
    table: str = "api_logs",
    properties: dict[str, str] | None = None,
    batch_size: int = BATCH_SIZE,
    connections: int = 16,
    types: str | None = None,
    set_aside: str | None = None,
) -> None:
    """Append rows in batches of ``batch_size`` over ``connections`` sessions.

    ``types`` are the column types of a table that Spark creates (default :func:`column_types`).
    Rows with a value that is too wide are written as JSON to ``set_aside``, or raise an error
    without that folder. Each task commits once, so a failed task leaves nothing behind.
    """
    wide = fitting(df)[1]
    if set_aside is not None:
        wide.write.mode("append").json(set_aside)
    elif found := wide.select("column").take(1):
        raise ValueError(f"{found[0][0]} holds values that are too wide; name a folder for such rows")
    options = {
        **(properties or {}),
        "batchsize": str(batch_size),
        "createTableColumnTypes": types or column_types(),
    }
    export_rows(df, connections).write.jdbc(url, table, mode="append", properties=options)
