"""Schemas and fixed vocabularies of the API log."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema of "name type, ..." (needs no running session, unlike DDL parsing)."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# The 18 fields of a raw JSON log line.
RAW_SCHEMA = _schema(
    "artist string, sessionId int, userId string, location string, status int, "
    "userAgent string, lastName string, method string, registration double, "
    "song string, level string, itemInSession int, ts double, firstName string, "
    "length float, auth string, gender string, page string"
)

# The 27 columns of the enriched log, in storage order.
LOG_SCHEMA = _schema(
    "artist string, sessionId int, userId string, location string, status int, "
    "userAgent string, userAgent_browser_family string, userAgent_browser_version string, "
    "userAgent_os_family string, userAgent_os_version string, userAgent_is_mobile boolean, "
    "userAgent_is_pc boolean, userAgent_is_tablet boolean, lastName string, method string, "
    "registration double, registration_timestamp timestamp, song string, level string, "
    "itemInSession int, ts double, timestamp timestamp, firstName string, length float, "
    "auth string, gender string, page string"
)

PARTITION_COLUMN = "date"
LAKE_SCHEMA = T.StructType(LOG_SCHEMA.fields + [T.StructField(PARTITION_COLUMN, T.DateType())])

CORRUPT_COLUMN = "_corrupt_record"

# The pages that make a user a churner.
CHURN_PAGES = ("Submit Downgrade", "Cancellation Confirmation")

# Pages that would give the label away, removed from the features.
LEAKAGE_PAGES = ("Cancellation Confirmation", "Submit Downgrade", "Downgrade", "Cancel")

SONG_PAGE = "NextSong"
