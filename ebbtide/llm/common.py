"""Helpers shared by the operators: tables, scratch tables, column names."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import drop_table, scratch_path

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4_000_000  # of rows on their way to a Python worker
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs inside send rows to Python workers in batches of some megabytes, unless the session has a bound of its own.

    Ten thousand texts, the default, lie in the JVM's buffers and in the worker at once, on the way there
    and back. A row is never cut, and no result depends on where batches end.
    """
    if spark.conf.get(ARROW_BYTES, None) is not None:
        yield
        return
    spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(ARROW_BYTES)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: what follows never recomputes it."""
    path = scratch_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more."""
    for one in tables:
        drop_table(one)


def releasing(function: Callable) -> Callable:
    """``function`` over the batches of a task; the memory it freed goes back to the system at the end.

    A worker outlives its task: what its allocators keep lies beside the joins and sorts of later stages.
    """

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return run


def arrow_map(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on every executor.

    The driver hands Spark a zip of the package, once per application, as ``--py-files`` would.
    """
    context = df.sparkSession.sparkContext
    if not any(name.startswith("ebbtide-code") for name in context._python_includes):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        staged = os.path.join(tempfile.mkdtemp(prefix="ebbtide-"), "ebbtide-code")
        context.addPyFile(shutil.make_archive(staged, "zip", os.path.dirname(package), os.path.basename(package)))
    return df.mapInArrow(releasing(function), schema)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, as ``id`` and ``text``; a null text is empty.

    Other columns of ``docs``, whatever they are called, are left behind here.
    """
    return docs.select(
        docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    )


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def free_name(taken: Iterable[str], base: str) -> str:
    """``base``, with underscores in front until no column of any case has the name."""
    known = {name.lower() for name in taken}
    while base.lower() in known:
        base = f"_{base}"
    return base


def type_name(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
