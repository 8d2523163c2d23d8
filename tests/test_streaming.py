import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbtide.operators.explore import time_counts
from ebbtide.streaming import series
from tests.helpers import DAY_MS, START_MS, log

HOUR = DAY_MS // 24


def at(hours, n=1, level="free"):
    return [{"ts": float(START_MS + hours * HOUR), "level": level}] * n


def counted(spark, folder, delay=dt.timedelta(hours=6)):
    stream = spark.readStream.schema(log(spark, at(0)).schema).parquet(f"{folder}/in")
    series.count_stream(
        series.time_rows(stream, "level", "1h"), f"{folder}/out", f"{folder}/checkpoint", delay
    ).awaitTermination()


def arrive(spark, folder, rows):
    log(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def values(df):
    return sorted((int(r["time"].timestamp() * 1000 - START_MS) // HOUR, r["metric"], r["value"]) for r in df.collect())


def parts(spark, folder):
    return [values(part(spark, f"{folder}/out")) for part in (series.closed_counts, series.late_counts, series.open_counts)]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_buckets_close_and_late_rows_are_kept_apart(spark, folder):
    arrive(spark, folder, at(0, 3) + at(1) + at(5, 2, "paid"))
    counted(spark, folder)
    # Nothing has a watermark of its own batch: all may still grow.
    assert parts(spark, folder) == [[], [], [(0, "free", 3), (1, "free", 1), (5, "paid", 2)]]
    arrive(spark, folder, at(8) + at(0))
    counted(spark, folder)  # the watermark was -1 h before this batch and is 2 h after it
    assert parts(spark, folder) == [[(0, "free", 4), (1, "free", 1)], [], [(5, "paid", 2), (8, "free", 1)]]
    arrive(spark, folder, at(0, 2) + at(1, 1, "paid") + at(5))
    counted(spark, folder)
    closed, late, held = parts(spark, folder)
    assert closed == [(0, "free", 4), (1, "free", 1)] and late == [(0, "free", 2), (1, "paid", 1)]
    assert held == [(5, "free", 1), (5, "paid", 2), (8, "free", 1)]
    whole = spark.read.parquet(f"{folder}/in")
    assert values(series.counts_so_far(spark, f"{folder}/out")) == values(time_counts(whole, "level", "1h"))


def test_state_is_bounded_by_the_delay(spark, folder):
    for hour in range(0, 60, 12):
        arrive(spark, folder, [row for k in range(12) for row in at(hour + k)])
        counted(spark, folder)
        assert len(values(series.open_counts(spark, f"{folder}/out"))) <= 7 + 12 * (hour == 0)
    assert [v for _, _, v in values(series.counts_so_far(spark, f"{folder}/out"))] == [1] * 60


def test_repeated_batch_changes_nothing(spark, folder, tmp_path):
    arrive(spark, folder, at(0) + at(9))
    counted(spark, folder)
    arrive(spark, folder, at(0) + at(20))
    counted(spark, folder)
    before = parts(spark, folder)
    commit = tmp_path / "checkpoint" / "commits" / "1"
    commit.unlink()
    (commit.parent / ".1.crc").unlink()
    mark = tmp_path / "out" / "batch=000000001" / "mark" / "_SUCCESS"
    mark.unlink()  # the run died before the batch was closed: what the one before left counts
    assert values(series.counts_so_far(spark, f"{folder}/out")) == [(0, "free", 1), (9, "free", 1)]
    counted(spark, folder)
    assert parts(spark, folder) == before


def test_nothing_and_unknown_intervals(spark, folder):
    assert series.counts_so_far(spark, f"{folder}/out").count() == 0
    arrive(spark, folder, [{"ts": float(START_MS), "level": None}])
    counted(spark, folder)
    arrive(spark, folder, at(1))
    counted(spark, folder)
    assert values(series.counts_so_far(spark, f"{folder}/out")) == [(1, "free", 1)]
    with pytest.raises(ValueError, match="interval"):
        series.time_rows(log(spark, at(0)), "level", "2h")
