"""Times every registered query and prints one JSON line.

BENCH_SF_DIR    tables to read (default /root/testdata/sf0.1)
BENCH_CPUS      local threads (default 8)
BENCH_QUERIES   comma-separated names (default all)
BENCH_TRIAL     copies of the log for the trial run instead of the queries (40 for 4 M rows at sf0.1)
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators import features
from ebbtide.plans import churn, training
from ebbtide.plans.ingest import ingest
from ebbtide.plans.registry import all_queries
from ebbtide.schema import RAW_SCHEMA
from ebbtide.session import build_session, materialize, scratch_path
from ebbtide.sources.event_log import PAGES, raw_log, read_events, with_item_position
from ebbtide.sources.lake import read_lake


def trial(spark: SparkSession, sf_dir: str, copies: int) -> dict[str, float]:
    """Ingest and prediction over the log ``copies`` times, with other users in each copy."""
    seconds: dict[str, float] = {}

    def timed(name: str, step: Callable[[], object]) -> object:
        start = time.perf_counter()
        out = step()
        seconds[name] = round(time.perf_counter() - start, 3)
        return out

    base = scratch_path(spark, "trial")
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    events = read_events(spark, sf_dir).withColumn("copy", copy)
    events = events.withColumn("user_id", F.col("user_id") + F.col("copy") * 1_000_003)
    raw = raw_log(with_item_position(events)).select(*RAW_SCHEMA.names)
    raw.write.json(f"{base}/json")
    timed("ingest", lambda: ingest(spark, f"{base}/json", f"{base}/lake"))
    timed("ingest with quarantine", lambda: ingest(spark, f"{base}/json", f"{base}/lake", f"{base}/bad"))
    log = read_lake(spark, f"{base}/lake")

    def frame() -> DataFrame:
        features.dataset_summary(log).collect()
        return materialize(churn.churn_features(log, PAGES), "trial")

    stored = timed("summary and features", frame)
    timed("four classifiers, fit and evaluate", lambda: training.compare(stored).collect())
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries = all_queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(queries)
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The session's own start-up is not part of any query.
    queries["churn_labels"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    copies = int(os.environ.get("BENCH_TRIAL", "0"))
    seconds: dict[str, float] = trial(spark, sf_dir, copies) if copies else {}
    for name in [] if copies else names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
