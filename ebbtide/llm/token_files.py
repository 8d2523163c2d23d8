"""Token-id files: concatenated ids with Elias-Fano encoded document boundaries.

A file is one block: a run of documents in ascending id order, range-partitioned by Spark. Layout,
little-endian::

    header    HEADER below: magic, id width, task, number, documents, null ids, tokens,
              smallest id, then the byte lengths of the sections
    bounds    Elias-Fano code of the n + 1 document boundaries within the block
    doc ids   Elias-Fano code of (id - smallest id), null ids left out (they come first)
    tokens    ids back to back, 2 bytes each below 65,536, else 4
    newline   closes the file (Spark's text writer puts it after each row)

An Elias-Fano code keeps the low bits of each value in a packed array and the high bits in unary:
about 2 + log2(universe / n) bits a value, against 64 for a table. A directory of every
``SAMPLE``-th place of the unary part is stored with the code, and ``select`` finds values from there. All
reading goes through it: a block is never decoded into a table of its boundaries. The start of a document over
the whole corpus is its boundary plus the tokens of the blocks before.

Files are written and read by Spark's own writers and readers, so any store that Spark reaches
will do. A block closes at ``block_tokens`` ids, so a file holds at most that and one document.

Defined results: a null or empty text is the end id alone; null ids come first; rows with equal
ids keep one entry each; an empty table gives no files; extra columns are ignored. A very long text is a block
by itself and costs its ids, four bytes each, a few times over.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import arrow_map, id_and_text
from ebbtide.llm.tokens import default_tokenizer, encoder

MAGIC = b"EBTOK01\n"
HEADER = struct.Struct("<8sIIIIIQqQQ")
BLOCK_TOKENS = 4_000_000
SAMPLE = 256  # one directory entry for so many values
FLUSH_BYTES = 8_000_000
DOCUMENTS = 2_048  # looked up at a time


class EliasFano:
    """A non-decreasing sequence of unsigned integers in near-minimal space."""

    HEAD = struct.Struct("<QQB")

    def __init__(self, count: int, universe: int, low_bits: int, directory: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.count, self.universe, self.low_bits = count, universe, low_bits
        self._directory, self._low, self._high = directory, low, high

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, int(math.floor(math.log2(top / n)))) if n and top > n else 0
        low = (values & np.uint64((1 << bits) - 1)) if bits else np.zeros(0, np.uint64)
        shifts = np.arange(bits, dtype=np.uint64)
        low_bits = ((low[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel() if bits else np.zeros(0, np.uint8)
        places = ((values >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)).astype(np.int64)
        high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        high[places] = 1
        packed = [np.packbits(part, bitorder="little") for part in (low_bits, high)]
        return cls(n, top, bits, places[::SAMPLE].astype("<u8"), *packed)

    def to_bytes(self) -> bytes:
        parts = (self._directory, self._low, self._high)
        return self.HEAD.pack(self.count, self.universe, self.low_bits) + b"".join(part.tobytes() for part in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        """The parts as they lie in ``data``; nothing is decoded."""
        count, universe, bits = cls.HEAD.unpack_from(data)
        entries = -(-count // SAMPLE)
        low = cls.HEAD.size + 8 * entries
        high = low + (count * bits + 7) // 8
        directory = np.frombuffer(data, "<u8", entries, cls.HEAD.size)
        return cls(count, universe, bits, directory, np.frombuffer(data[low:high], np.uint8), np.frombuffer(data[high:], np.uint8))

    def select(self, first: int, last: int | None = None) -> np.ndarray | int:
        """Value ``first``, or the values from there to before ``last``.

        The directory names the place of every ``SAMPLE``-th one of the unary part; from there on only the
        bytes of the wanted values are looked at.
        """
        end = first + 1 if last is None else last
        if not (0 <= first < self.count and first <= end <= self.count):
            raise IndexError(first)
        if first == end:
            return np.empty(0, np.int64)
        at, skip = int(self._directory[first // SAMPLE]), first % SAMPLE
        stop = int(self._directory[(end - 1) // SAMPLE])  # the last wanted one lies here or behind
        byte, upto = at >> 3, stop >> 3
        skip += int(np.unpackbits(self._high[byte : byte + 1], count=at & 7, bitorder="little").sum()) if at & 7 else 0
        while True:
            upto = min(len(self._high), upto + 1 + (SAMPLE >> 2))
            ones = np.flatnonzero(np.unpackbits(self._high[byte:upto], bitorder="little"))
            if len(ones) >= skip + end - first:
                break
        number = np.arange(first, end)
        high = (ones[skip : skip + end - first] + (byte << 3) - number).astype(np.int64) << self.low_bits
        found = high | self._low_parts(first, end)
        return int(found[0]) if last is None else found

    def _low_parts(self, first: int, end: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(end - first, np.int64)
        a, b = first * self.low_bits, end * self.low_bits
        bits = np.unpackbits(self._low[a >> 3 : (b + 7) >> 3], bitorder="little")[a & 7 : (a & 7) + b - a]
        weights = np.int64(1) << np.arange(self.low_bits, dtype=np.int64)
        return bits.reshape(-1, self.low_bits).astype(np.int64) @ weights


def pack_block(task: int, number: int, ids: list[int | None], lengths: list[int], tokens: bytes) -> bytes:
    """The bytes of a block, without the closing newline; ``tokens`` are little-endian uint32."""
    nulls = sum(i is None for i in ids)
    known = [i for i in ids if i is not None]
    base = known[0] if known else 0
    bounds = EliasFano.encode(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])).to_bytes()
    doc_ids = EliasFano.encode(np.array([i - base for i in known], np.uint64)).to_bytes()
    wide = np.frombuffer(tokens, "<u4")
    width = 4 if len(wide) and int(wide.max()) > 0xFFFF else 2
    head = HEADER.pack(MAGIC, width, task, number, len(ids), nulls, len(wide), base, len(bounds), len(doc_ids))
    return head + bounds + doc_ids + (tokens if width == 4 else wide.astype("<u2").tobytes())


def read_header(data: bytes) -> tuple:
    found = HEADER.unpack_from(data)
    if found[0] != MAGIC:
        raise ValueError("not a token file")
    return found


class Block:
    """A block as it was read: documents are found by ``select`` on its boundaries and ids."""

    def __init__(self, data: bytes):
        _, self._width, self.task, self.number, self.documents, self._nulls, self.tokens, self._base, bounds, doc_ids = read_header(data)
        at = HEADER.size
        self._bounds = EliasFano.from_bytes(data[at : at + bounds])
        self._ids = EliasFano.from_bytes(data[at + bounds : at + bounds + doc_ids])
        self._data, self._first = data, at + bounds + doc_ids

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Where documents ``first`` to before ``last`` start, and where the last of them ends."""
        return self._bounds.select(first, last + 1)

    def ids(self, first: int, last: int) -> list[int | None]:
        """Their ids; null ids come first."""
        nulls = max(0, min(last, self._nulls) - first)
        known = max(first, self._nulls) - self._nulls, last - self._nulls
        found = self._ids.select(*known).tolist() if known[0] < known[1] else []
        return [None] * nulls + [self._base + x for x in found]

    def token_ids(self, start: int, end: int) -> np.ndarray:
        return np.frombuffer(self._data, f"<u{self._width}", end - start, self._first + start * self._width).astype("<u4")


def write_token_files(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: str | None = None, end_id: int = 2, block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Encodes ``docs`` and writes one file a block under ``path``, in ascending id order."""
    import pyarrow as pa

    file = tokenizer or default_tokenizer()
    texts = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, task = encoder(file).encode, end_id.to_bytes(4, "little"), TaskContext.get().partitionId()
        ids, lengths, parts, total, number = [], [], [], 0, 0
        for batch in batches:
            for doc, tokens in zip(batch.column(0), encode(text.as_py() for text in batch.column(1).cast("binary"))):
                tokens += end
                ids.append(doc.as_py())
                lengths.append(len(tokens) // 4)
                parts.append(tokens)
                total += lengths[-1]
                if total >= block_tokens:
                    yield pa.RecordBatch.from_pydict({"block": [pack_block(task, number, ids, lengths, b"".join(parts))]})
                    ids, lengths, parts, total, number = [], [], [], 0, number + 1
        if ids:
            yield pa.RecordBatch.from_pydict({"block": [pack_block(task, number, ids, lengths, b"".join(parts))]})

    # ``row`` lets a range end among rows of one id, or of none.
    texts = texts.withColumn("row", F.monotonically_increasing_id())
    ordered = texts.repartitionByRange("id", "row").sortWithinPartitions("id", "row").drop("row")
    # The text writer puts the bytes of a string out as they are; one block a file.
    arrow_map(ordered, blocks, "block binary").select(F.col("block").cast("string").alias("value")).write.option(
        "maxRecordsPerFile", 1
    ).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, task, number, block_start, n_tokens, ids (little-endian uint32)."""
    import pyarrow as pa

    schema = f"`{id_col}` long, task long, number long, block_start long, n_tokens long, ids binary"

    def rows(ids, task, number, starts, lengths, tokens):
        n = len(ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()), pa.array([task] * n, pa.int64()), pa.array([number] * n, pa.int64()),
                pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(tokens, pa.binary()),
            ],
            names=[id_col, "task", "number", "block_start", "n_tokens", "ids"],
        )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                block = Block(content.as_py())
                for some in range(0, block.documents, DOCUMENTS):
                    bounds = block.bounds(some, min(some + DOCUMENTS, block.documents))
                    ids = block.ids(some, some + len(bounds) - 1)
                    first = 0
                    while first < len(ids):  # some megabytes of ids at a time
                        last = int(np.searchsorted(bounds, bounds[first] + FLUSH_BYTES // 4, "right")) - 1
                        last = min(len(ids), max(first + 1, last))
                        edges = bounds[first : last + 1]
                        tokens = block.token_ids(edges[0], edges[-1])
                        parts = [tokens[a:b].tobytes() for a, b in zip(edges[:-1] - edges[0], edges[1:] - edges[0])]
                        yield rows(ids[first:last], block.task, block.number, edges[:-1], np.diff(edges), parts)
                        first = last

    return arrow_map(_files(spark, path).select("content"), documents, schema)


def with_start(documents: DataFrame) -> DataFrame:
    """``documents`` of :func:`read_token_files`, with or without their ids and with any extra columns,
    with their start over the corpus.

    The blocks' sizes are summed up from the rows, first within each writing task, then over the tasks,
    of which there is one row each. ``documents`` should be a written table, as it is read twice.
    """
    blocks = documents.groupBy("task", "number").agg(F.sum("n_tokens").alias("tokens"))
    inside = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    tasks = blocks.groupBy("task").agg(F.sum("tokens").alias("tokens"))
    over = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task", F.coalesce(F.sum("tokens").over(over), F.lit(0)).alias("before"))
    base = blocks.withColumn("within", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(tasks, "task").select(
        "task", "number", (F.col("before") + F.col("within")).alias("base")
    )
    return documents.join(base, ["task", "number"]).withColumn("start", F.col("base") + F.col("block_start")).drop("base")
