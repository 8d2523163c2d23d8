"""Incremental ingest of newly arrived log files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ebbtide.plans.ingest import BAD, stage, staged_bad
from ebbtide.session import Folder
from ebbtide.sources.json_log import parse_lines
from ebbtide.sources.lake import publish_batch


def ingest_stream(
    spark: SparkSession,
    source_dir: str,
    lake: str,
    checkpoint: str,
    quarantine: str | None = None,
    max_files: int | None = None,
    stream: str = "stream",
) -> StreamingQuery:
    """Take in the files that are new since the last run, then stop.

    ``max_files`` bounds a micro-batch, for a first run over a large backlog. Each file is read and
    parsed once for both sinks: a batch is staged in one job, good and bad lines apart, and then
    published. Its files carry the names of the stream and the batch, and its bad lines lie in a
    ``batch=`` folder of the quarantine, so a batch that Spark runs again after a failure replaces what it
    wrote before and adds nothing. Every ``stream`` that feeds a lake needs a name of its own.

    Rows of a day are brought together before they are written, so a batch adds few files to a day,
    however many tasks read.
    """
    if not re.fullmatch(r"\w+", stream):
        raise ValueError(f"stream must be a word, not {stream!r}")

    def take(lines: DataFrame, number: int) -> None:
        session, name = lines.sparkSession, f"{stream}-{number:09}"
        staged = Folder(session, lake) / f"_staged-{name}"
        stage(parse_lines(lines), str(staged))
        if quarantine:
            folder = Folder(session, quarantine) / f"batch={name}"
            folder.delete()
            if (staged / f"{BAD}=true").exists():
                staged_bad(session, str(staged)).write.json(str(folder))
        publish_batch(staged / f"{BAD}=false", Folder(session, lake), name)
        staged.delete()

    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.text(source_dir)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
