"""Exact deduplication: a two-pass Bloom filter names the rows that may have an equal.

Pass one counts, for every row, ``HASHES`` bit positions of its text's digest inside one block of
a blocked Bloom filter. A bit stays set when at least two rows hit it. Pass two tests each row
against those bits: a row with a clear bit has no equal anywhere and passes straight through;
only the others are shuffled and grouped by digest. False positives cost a shuffled row, never a
wrong result.

The filter is broadcast. It has ``BITS_PER_ROW`` bits a row but at most ``max_blocks`` blocks of
4 KB (32 MB by default), whatever the input; a fuller filter only lets more rows into the
shuffle. Everything is DataFrame functions: no Python runs on the executors.

Defined results: a null text counts as empty, and empty texts are equal to each other; a null id
is smaller than any id; of rows equal in id and text exactly one stays; an empty table gives an
empty result; extra columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import free_name, id_and_text, written

BLOCK_BITS = 32_768
BITS_PER_ROW = 16
HASHES = 3
MAX_BLOCKS = 8_192


@dataclass(frozen=True)
class Repeats:
    """What the two passes found: the filter's blocks and the groups of two or more rows."""

    blocks: int
    bits: DataFrame  # block, bits
    digests: DataFrame  # id, row, digest
    groups: DataFrame  # digest, keep_id, keep_row, group_size


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def _block(digest: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(blocks)).cast("int")


def _positions(digest: Column) -> list[Column]:
    return [
        F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(BLOCK_BITS)).cast("int")
        for k in range(1, HASHES + 1)
    ]


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, position.bitwiseAND(~7) / 8 + 1, 1)), 16, 10).cast("int")
    return F.call_function("getbit", byte, position.bitwiseAND(7)) == 1


def _maybe_repeated(rows: DataFrame, digest: str, found_bits: DataFrame, blocks: int, flag: str) -> DataFrame:
    """``rows`` with ``flag``: false means that no other row has this digest."""
    block, bits = free_name(rows.columns, "block"), free_name(rows.columns, "bits")
    joined = rows.withColumn(block, _block(F.col(digest), blocks)).join(
        F.broadcast(found_bits.toDF(block, bits)), block, "left"
    )
    test = F.col(bits).isNotNull()
    for position in _positions(F.col(digest)):
        test = test & _is_set(F.col(bits), position)
    return joined.withColumn(flag, F.coalesce(test, F.lit(False))).drop(block, bits)


def find_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_blocks: int = MAX_BLOCKS
) -> Repeats:
    """Both passes over ``docs``. ``max_blocks`` bounds the broadcast filter at 4 KB a block."""
    rows = id_and_text(docs, id_col, text_col).select(
        "id", F.monotonically_increasing_id().alias("row"), _digest(F.col("text")).alias("digest")
    )
    digests = written(rows, "digests")
    blocks = max(1, min(max_blocks, -(-digests.count() * BITS_PER_ROW // BLOCK_BITS)))
    hits = digests.select(
        _block(F.col("digest"), blocks).alias("block"),
        F.explode(F.array_distinct(F.array(*_positions(F.col("digest"))))).alias("position"),
    )
    bits = (
        hits.groupBy("block", "position")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .groupBy("block")
        .agg(F.bitmap_construct_agg(F.col("position").cast("long")).alias("bits"))
    )
    bits = written(bits, "bloom")
    flagged = _maybe_repeated(digests, "digest", bits, blocks, "flag").where("flag")
    groups = (
        flagged.groupBy("digest")
        .agg(F.max(F.struct("id", "row")).alias("last"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select("digest", F.col("last.id").alias("keep_id"), F.col("last.row").alias("keep_row"), "group_size")
    )
    # Written, so that the join below shuffles both sides and a hot digest can be split.
    return Repeats(blocks, bits, digests, written(groups, "groups"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    found = find_repeats(docs, id_col, text_col, **options)
    marked = _maybe_repeated(found.digests, "digest", found.bits, found.blocks, "flag")
    alone = marked.where("not flag").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "digest",
    )
    grouped = marked.where("flag").join(found.groups, "digest", "left")
    single = F.col("group_size").isNull()
    grouped = grouped.select(
        "id",
        F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "digest",
    )
    return alone.unionByName(grouped).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, all columns; only possibly repeated rows are shuffled."""
    found = find_repeats(docs, id_col, text_col, **options)
    digest = free_name(docs.columns, "digest")
    flag = free_name(docs.columns, "flag")
    marked = _maybe_repeated(
        docs.withColumn(digest, _digest(docs[text_col])), digest, found.bits, found.blocks, flag
    )
    alone = marked.where(~F.col(flag))
    keep, size = free_name(docs.columns, "keep_id"), free_name(docs.columns, "group_size")
    groups = found.groups.select(
        F.col("digest").alias(digest), F.col("keep_id").alias(keep), F.col("group_size").alias(size)
    )
    flagged = marked.where(F.col(flag)).join(groups, digest, "left")
    single = flagged.where(F.col(size).isNull())
    last = flagged.where(F.col(size).isNotNull() & F.col(id_col).eqNullSafe(F.col(keep)))
    kept = last.dropDuplicates([digest]).select(*docs.columns)
    return alone.select(*docs.columns).unionByName(single.select(*docs.columns)).unionByName(kept)
