"""A filter of bounded size over 64-bit hashes, made by Spark, tested in the JVM or with numpy.

It has ``1 << (BLOCK_BITS + 15)`` bits (32 MB) at most, in blocks of 4 KB; the leading bits of a hash
name its bit. Filters over the keys of a table have ``BITS_A_KEY`` bits a key up to that bound, so that
few keys are not 32 MB in the driver; filters over hashes come to it as the places of their bits where
these are few, some megabytes at a time. A fuller filter lets more rows through; what passes is always
checked exactly by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ebbtide.llm.common import arrow_map, dropped, free_name, written

BLOCK_BITS = 13
POSITION_BITS = 15
BUCKET_BITS = 10
BITS_A_KEY = 128
FLUSH_ROWS = 2_000_000
FETCH_BYTES = 4_000_000  # of a filter on its way to the driver


@dataclass(frozen=True)
class FilterBits:
    """The filter as bytes, for tasks in Python."""

    data: np.ndarray

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - BLOCK_BITS - POSITION_BITS)
        byte = self.data[(place >> np.uint64(3)).astype(np.int64)]
        return (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _block_bits(keys: int) -> int:
    """Leading bits of a hash that name its block, in a filter over so many keys."""
    return min(BLOCK_BITS, max(1, (keys * BITS_A_KEY).bit_length() - POSITION_BITS))


def _place(hashed: Column, block_bits: int) -> tuple[Column, Column]:
    block = F.shiftrightunsigned(hashed, 64 - block_bits).cast("int")
    position = F.shiftrightunsigned(hashed, 64 - block_bits - POSITION_BITS).bitwiseAND((1 << POSITION_BITS) - 1)
    return block, position


def filter_blocks(hashes: DataFrame, hashed: Column, block_bits: int = BLOCK_BITS) -> DataFrame:
    """block, bits: the filter as a written table of at most ``1 << block_bits`` rows."""
    block, position = _place(hashed, block_bits)
    bits = hashes.select(block.alias("block"), position.alias("position")).groupBy("block").agg(
        F.bitmap_construct_agg("position").alias("bits")
    )
    return written(bits, "filter")


def hash_filter(rows: DataFrame, hashes_of: Callable[[Iterator], Iterable[np.ndarray]], least: int = 1) -> Broadcast:
    """A filter over the hashes that ``hashes_of`` gives for the batches of a task.

    ``least``: 1 for all hashes, 2 for those that occur at least twice. Tasks send 32 bits of each
    distinct hash, in buckets; a bucket is made up in one task, which holds no more than its share.
    """
    import pyarrow as pa

    rest_bits, bits_a_bucket = 64 - BUCKET_BITS - 32, BLOCK_BITS + POSITION_BITS - BUCKET_BITS

    def distinct(batches):
        held, size = [], 0
        for found in hashes_of(batches):
            held.append(found)
            size += len(found)
            if size > FLUSH_ROWS:
                yield _buckets(np.concatenate(held))
                held, size = [], 0
        if size:
            yield _buckets(np.concatenate(held))

    def _buckets(keys):
        keys, counts = np.unique(keys, return_counts=True)
        rest = ((keys >> np.uint64(rest_bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        edges = np.searchsorted((keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.arange((1 << BUCKET_BITS) + 1))
        number, once, again = zip(
            *[
                (k, rest[a:b].tobytes(), rest[a:b][counts[a:b] > 1].tobytes())
                for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a
            ]
        )
        return pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int64()), pa.array(once, pa.binary()), pa.array(again, pa.binary())],
            names=["bucket", "once", "again"],
        )

    def bits(batches):
        once, again = {}, {}
        for batch in batches:
            for bucket, a, b in zip(*[column.to_pylist() for column in batch.columns]):
                once.setdefault(bucket, []).append(np.frombuffer(a, np.uint32))
                again.setdefault(bucket, []).append(np.frombuffer(b, np.uint32))
        for bucket in sorted(once):
            found = np.concatenate(once.pop(bucket))
            if least > 1:
                found.sort()
                found = np.concatenate([found[1:][found[1:] == found[:-1]], *again.pop(bucket)])
            places = np.unique(found >> np.uint32(32 - bits_a_bucket))
            if places.nbytes >= size:
                flags = np.zeros(1 << bits_a_bucket, np.uint8)
                flags[places] = 1
                places = np.packbits(flags, bitorder="little")
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int64()), pa.array([places.tobytes()], pa.binary())], names=["bucket", "bits"]
            )

    sent = arrow_map(rows, distinct, "bucket long, once binary, again binary").repartition("bucket")
    size = 1 << (bits_a_bucket - 3)
    data = np.zeros(size << BUCKET_BITS, np.uint8)
    stored = written(arrow_map(sent, bits, "bucket long, bits binary"), "filter")
    for row in _fetched(stored):
        own = data[row["bucket"] * size : (row["bucket"] + 1) * size]
        if len(row["bits"]) == size:
            own[:] = np.frombuffer(row["bits"], np.uint8)
        else:  # fewer bytes: the places
            places = np.frombuffer(row["bits"], np.uint32)
            np.bitwise_or.at(own, places >> np.uint32(3), np.uint8(1) << (places & np.uint32(7)).astype(np.uint8))
    dropped(stored)
    return rows.sparkSession.sparkContext.broadcast(FilterBits(data))


def _fetched(stored: DataFrame) -> Iterator[Row]:
    """The rows of a filter, ``FETCH_BYTES`` at a time, however they lie in files."""
    lengths = sorted(stored.select("bucket", F.length("bits")).collect())
    edges, held = [], 0
    for bucket, length in lengths:
        if not edges or held + length > FETCH_BYTES:
            edges, held = [*edges, bucket], 0
        held += length
    for low, high in zip(edges, [*edges[1:], 1 << BUCKET_BITS]):
        yield from stored.where(F.col("bucket").between(low, high - 1)).collect()


def marked(rows: DataFrame, key: str, keys: DataFrame, flag: str = "maybe", hashed: bool = False) -> DataFrame:
    """``rows`` with ``flag``: false where the key is certainly not among ``keys`` (same column name).

    ``hashed``: the key is a hash already. ``keys`` is counted first, so a written table is best.
    """
    mix = (lambda c: c) if hashed else F.xxhash64
    block, bits = free_name(rows.columns, "block"), free_name(rows.columns, "bits")
    block_bits = _block_bits(keys.count())
    found = filter_blocks(keys, mix(F.col(key)), block_bits).toDF(block, bits)
    at, position = _place(mix(F.col(key)), block_bits)
    joined = rows.withColumn(block, at).join(F.broadcast(found), block, "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), (position.bitwiseAND(~7) / 8 + 1).cast("int"), 1)), 16, 10).cast("int")
    test = F.call_function("getbit", byte, position.bitwiseAND(7).cast("int")) == 1
    return joined.withColumn(flag, F.coalesce(test, F.lit(False))).drop(block, bits)


def maybe_in(rows: DataFrame, key: str, keys: DataFrame, hashed: bool = False) -> DataFrame:
    """Rows whose key may be among ``keys``; the others certainly are not."""
    flag = free_name(rows.columns, "maybe")
    return marked(rows, key, keys, flag, hashed).where(F.col(flag)).drop(flag)
