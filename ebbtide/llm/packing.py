"""Packing documents into training sequences: shortest-pack-first over the length histogram.

Documents become token ids with an end id, cut into pieces of at most ``capacity`` ids. Packing
looks only at the histogram of piece lengths (``capacity`` counters, exact over all pieces):
lengths are placed from the longest to the shortest, always into the open packs with the most
room, by counts and not one by one. The result is a list of patterns with counts. Pieces meet
their pattern by rank: the k-th piece of a length takes the k-th place for that length.

Ranks need no global sort. The task that cuts a piece numbers it among its own pieces of the
length; the counts per task and length, summed over the tasks before it, shift these numbers.
Only the histogram reaches the driver and only the places (bounded by ``capacity``) are broadcast.

Defined results: a null or empty text is one piece, the end id alone; null ids and repeated rows
are packed like any other row; an empty table gives no pieces; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import arrow_map, id_and_text, type_name, written
from ebbtide.llm.tokens import default_tokenizer, encoder

CAPACITY = 1024
FLUSH_BYTES = 8_000_000


@dataclass(frozen=True)
class Place:
    """``count`` sequences from ``sequence`` on hold, from ``offset``, the pieces of ``length`` ranked ``low`` to ``high``."""

    length: int
    low: int
    high: int
    sequence: int
    count: int
    offset: int


Pattern = tuple[tuple[int, int], ...]


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns ((length, copies), ...) with the number of sequences that have them."""
    by_room: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []  # a heap of the rooms in use, negated

    def put(room: int, pattern: Pattern, count: int) -> None:
        if room not in by_room:
            heapq.heappush(rooms, -room)
        by_room.setdefault(room, []).append((pattern, count))

    for length in sorted((n for n, count in histogram.items() if count), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit a sequence of {capacity}")
        left = histogram[length]
        while left:
            if not rooms or -rooms[0] < length:  # no open pack has room: open as few as can hold the rest
                put(capacity, (), -(-left // (capacity // length)))
            room = -rooms[0]
            pattern, count = by_room[room].pop()
            if not by_room[room]:
                del by_room[heapq.heappop(rooms) * -1]
            placed = min(left, count)
            left -= placed
            if count > placed:
                put(room, pattern, count - placed)
            same = pattern and pattern[-1][0] == length
            longer = (*pattern[:-1], (length, pattern[-1][1] + 1)) if same else (*pattern, (length, 1))
            put(room - length, longer, placed)
    return [pack for room in sorted(by_room) for pack in by_room[room]]


def places(patterns: list[tuple[Pattern, int]]) -> list[Place]:
    out, sequence, rank = [], 0, {}
    for pattern, count in patterns:
        offset = 0
        for length, copies in pattern:
            low = rank.get(length, 0)
            rank[length] = low + copies * count
            out.append(Place(length, low, rank[length], sequence, count, offset))
            offset += length * copies
        sequence += count
    return out


def cut(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    tokenizer: str | None = None, end_id: int = 0,
) -> DataFrame:
    """Pieces: id, start, length, doc_tokens, ids (little-endian uint32), task, number."""
    import pyarrow as pa

    path = tokenizer or default_tokenizer()
    texts = id_and_text(docs, id_col, text_col)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, task = encoder(path).encode, end_id.to_bytes(4, "little"), TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            ids, rows, size = batch.column(0), ([], [], [], [], [], []), 0
            for at, tokens in enumerate(encode(text.as_py() for text in batch.column(1).cast("binary"))):
                tokens += end
                total = len(tokens) // 4
                for start in range(0, total, capacity):
                    piece = tokens[4 * start : 4 * (start + capacity)]
                    length = len(piece) // 4
                    for column, value in zip(rows, (at, start, length, total, piece, seen[length])):
                        column.append(value)
                    seen[length] += 1
                    size += len(piece)
                if size > FLUSH_BYTES:
                    yield _pieces(ids, rows, task)
                    rows, size = ([], [], [], [], [], []), 0
            if rows[0]:
                yield _pieces(ids, rows, task)

    def _pieces(ids, rows, task):
        at, start, length, total, piece, number = rows
        return pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                pa.array(total, pa.int64()), pa.array(piece, pa.binary()),
                pa.array([task] * len(at), pa.int64()), pa.array(number, pa.int64()),
            ],
            names=["id", "start", "length", "doc_tokens", "ids", "task", "number"],
        )

    schema = (
        f"id {type_name(texts, 'id')}, start long, length long, doc_tokens long, ids binary, task long, number long"
    )
    return written(arrow_map(texts, pieces, schema), "pieces")


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table, any extra columns) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = written(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    found = places(shortest_pack_first(histogram, capacity))
    slots = spark.createDataFrame(
        [(p.length, p.low, p.high, p.sequence, p.count, p.offset) for p in found],
        "length long, low long, high long, sequence long, count long, at long",
    )
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    ranked = pieces.join(shifts, ["task", "length"]).withColumn("rank", F.col("shift") + F.col("number"))
    hit = ranked.alias("p").join(
        F.broadcast(slots.alias("s")),
        (F.col("p.length") == F.col("s.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    turn = F.col("rank") - F.col("low")
    return hit.select(
        *[F.col(f"p.{c}").alias(c) for c in pieces.columns if c not in ("task", "number")],
        (F.col("sequence") + turn % F.col("count")).alias("sequence_id"),
        (F.col("at") + F.floor(turn / F.col("count")).cast("long") * F.col("s.length")).alias("offset"),
    )


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, **options) -> DataFrame:
    """Every piece with its ids and its place: id, start, length, doc_tokens, ids, sequence_id, offset."""
    return place(cut(docs, id_col, text_col, capacity, **options), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the pieces joined up; a group is one sequence."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("length"),
        F.aggregate("parts", F.lit(b""), lambda b, p: F.concat(b, p["ids"])).alias("ids"),
    )
