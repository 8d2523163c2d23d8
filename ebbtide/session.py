"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "ebbtide", master: str | None = None, partitions: int | None = None, **conf
) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots.

    ``partitions`` is the number that shuffles start with, before adaptive execution merges small
    ones; about one per 100 to 200 MB of the largest shuffle (20,000 for 100 TB is a fair start).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The JVM never compiles methods over 8000 bytes: let Spark split such stages.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Recording a call site per column costs more than planning the query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if partitions:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions
        )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Large results are fetched through the driver's own address.
            builder = builder.config("spark.driver.bindAddress", "127.0.0.1").config(
                "spark.driver.host", "127.0.0.1"
            )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where it is unset in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ebbtide-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/ebbtide/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a written table, so a lost executor costs a re-read only."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(stored: DataFrame) -> None:
    """Delete the files of a table made by :func:`materialize` that nothing reads any more."""
    for file in stored.inputFiles()[:1]:
        Folder(stored.sparkSession, file.rpartition("/")[0]).delete()


class Folder:
    """A folder in any store that Spark reaches: listing, moving and deleting by Hadoop's own calls."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._spark, self._new = spark, context._jvm.org.apache.hadoop.fs.Path
        self._path = self._new(path.rstrip("/"))
        self._store = self._path.getFileSystem(context._jsc.hadoopConfiguration())

    def __truediv__(self, name: str) -> Folder:
        return Folder(self._spark, f"{self._path.toString()}/{name}")

    def __str__(self) -> str:
        return self._path.toString()

    def exists(self) -> bool:
        return self._store.exists(self._path)

    def names(self, pattern: str = "*") -> list[str]:
        """Names in the folder that match ``pattern``, sorted; none if there is no such folder."""
        found = self._store.globStatus(self._new(self._path, pattern)) or []
        return sorted(status.getPath().getName() for status in found)

    def delete(self) -> None:
        self._store.delete(self._path, True)

    def move(self, to: Folder) -> None:
        """Rename to ``to``, whose own folder is made if need be; an error if the store refuses."""
        self._store.mkdirs(to._path.getParent())
        if not self._store.rename(self._path, to._path):
            raise OSError(f"could not move {self} to {to}")
