"""API log derived from the ``events`` table (the rules of FIXTURES.md section 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.plans.ingest import enrich

SESSION_MS = 3 * 24 * 3600 * 1000
SLICE_MS = 1000

# User agents by user_id % 8.
USER_AGENTS = (
    "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0.1985.143 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4) AppleWebKit/537.77.4 (KHTML, like Gecko) Version/7.0.5 Safari/537.77.4",
    "Mozilla/5.0 (Windows NT 6.1; WOW64; rv:31.0) Gecko/20100101 Firefox/31.0",
    "Mozilla/5.0 (Windows NT 6.1; WOW64; Trident/7.0; rv:11.0) like Gecko",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2 like Mac OS X) AppleWebKit/537.51.2 (KHTML, like Gecko) Version/7.0 Mobile/11D257 Safari/9537.53",
    "Mozilla/5.0 (iPad; CPU OS 7_1_2 like Mac OS X) AppleWebKit/537.51.2 (KHTML, like Gecko) Version/7.0 Mobile/11D257 Safari/9537.53",
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0.1985.125 Safari/537.36",
    "Mozilla/5.0 (Linux; Android 4.4.2; Nexus 5) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/36.0.1985.131 Mobile Safari/537.36",
)

# Every page the derivation can produce.
PAGES = (
    "Add Friend",
    "Add to Playlist",
    "Cancel",
    "Cancellation Confirmation",
    "Downgrade",
    "Error",
    "Help",
    "Home",
    "NextSong",
    "Submit Downgrade",
    "Submit Upgrade",
    "Thumbs Up",
    "Upgrade",
)


PAGE = """
CASE event_type
  WHEN 'click' THEN 'NextSong'
  WHEN 'error' THEN 'Error'
  WHEN 'signup' THEN if(k % 2 = 0, 'Upgrade', 'Submit Upgrade')
  WHEN 'view' THEN CASE k % 4 WHEN 0 THEN 'Home' WHEN 1 THEN 'Help'
                              WHEN 2 THEN 'Thumbs Up' ELSE 'Add Friend' END
  ELSE CASE WHEN user_id % 5 = 0 AND k % 10 = 0 THEN 'Submit Downgrade'
            WHEN user_id % 7 = 0 AND k % 10 = 1 THEN 'Cancellation Confirmation'
            WHEN k % 10 = 2 THEN 'Downgrade'
            WHEN k % 10 = 3 THEN 'Cancel'
            ELSE 'Add to Playlist' END
END"""


def epoch_ms(events: DataFrame) -> str:
    """Milliseconds of an event; a time without zone is UTC, whatever the session's zone."""
    if events.schema["ts"].dataType.simpleString() == "timestamp":
        return "unix_millis(ts)"
    return (
        "unix_date(CAST(ts AS DATE)) * 86400000L + hour(ts) * 3600000L + minute(ts) * 60000L "
        "+ CAST(floor(extract(SECOND FROM ts) * 1000) AS BIGINT)"
    )


def raw_log(events: DataFrame) -> DataFrame:
    """``event_id`` and the raw fields, row by row; ``itemInSession`` if it was added."""
    items = [name for name in ("itemInSession",) if name in events.columns]
    agents = ", ".join(f"'{agent}'" for agent in USER_AGENTS)
    base = events.selectExpr(
        "*",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
        f"{epoch_ms(events)} AS ms",
    ).withColumn("page", F.expr(PAGE))
    return base.selectExpr(
        "event_id",
        *items,
        "if(page = 'NextSong', concat('artist_', k % 20), NULL) AS artist",
        f"CAST(floor(ms / {SESSION_MS}) AS INT) AS sessionId",
        "CASE WHEN k = 98 THEN '' WHEN k != 99 THEN CAST(user_id AS STRING) END AS userId",
        "concat('city_', user_id % 10) AS location",
        "CASE WHEN page = 'Error' THEN 404 WHEN k % 8 = 0 THEN 307 ELSE 200 END AS status",
        f"if(k != 97, element_at(array({agents}), CAST(user_id % 8 AS INT) + 1), NULL) AS userAgent",
        "concat('Last_', user_id % 50) AS lastName",
        "if(event_type IN ('view', 'error'), 'GET', 'PUT') AS method",
        "if(k != 99, CAST(1514764800000 + user_id * 86400000 AS DOUBLE), NULL) AS registration",
        "if(page = 'NextSong', concat('song_', k), NULL) AS song",
        "if(value < 110, 'free', 'paid') AS level",
        "CAST(ms AS DOUBLE) AS ts",
        "concat('First_', user_id % 30) AS firstName",
        "if(page = 'NextSong', CAST(value AS FLOAT), NULL) AS length",
        "CASE WHEN k >= 98 THEN 'Logged Out' WHEN k % 25 = 0 THEN 'Guest' ELSE 'Logged In' END AS auth",
        "if(k != 99, if(user_id % 5 < 3, 'M', 'F'), NULL) AS gender",
        "page",
    )


def with_item_position(events: DataFrame) -> DataFrame:
    """Add ``itemInSession``: position by time within a user's session.

    A session is ranked in slices of a second and each slice is shifted by the rows before
    it, so a user with a large share of all rows spreads over many tasks.
    """
    ms = F.expr(epoch_ms(events))
    rows = events.withColumns(
        {"sid": F.floor(ms / SESSION_MS), "slice": F.floor(ms / SLICE_MS)}
    )
    keys = ["user_id", "sid", "slice"]
    earlier = (
        Window.partitionBy("user_id", "sid")
        .orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        rows.groupBy(*keys)
        .count()
        .select(*keys, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("shift"))
    )
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(ms, "event_id"))
    return (
        rows.withColumn("position", within)
        .join(shifts, keys)
        .withColumn("itemInSession", (F.col("position") + F.col("shift") - 1).cast("int"))
        .drop("sid", "slice", "position", "shift")
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_log(spark: SparkSession, sf_dir: str, items: bool = False) -> DataFrame:
    """The enriched log; ``itemInSession``, which no analysis reads, only on request."""
    events = read_events(spark, sf_dir)
    return enrich(raw_log(with_item_position(events) if items else events))
