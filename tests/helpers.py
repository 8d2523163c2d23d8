from pyspark.sql import functions as F

from ebbtide.plans.ingest import enrich
from ebbtide.schema import RAW_SCHEMA

CHROME = "Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.36 Chrome/36.0.1985.143 Safari/537.36"
DAY_MS = 86_400_000
START_MS = 1_538_352_000_000  # 2018-10-01T00:00:00Z


def raw(spark, rows):
    """Raw log rows from dicts; absent fields are NULL."""
    names = RAW_SCHEMA.names
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], RAW_SCHEMA)


def log(spark, rows):
    """Enriched log rows with sensible defaults."""
    base = {
        "userId": "1", "sessionId": 1, "page": "Home", "ts": float(START_MS), "method": "GET",
        "status": 200, "level": "free", "auth": "Logged In", "userAgent": CHROME,
    }
    return enrich(raw(spark, [base | row for row in rows]))


def one(df, user="1"):
    (row,) = df.where(F.col("userId") == user).collect()
    return row.asDict()
