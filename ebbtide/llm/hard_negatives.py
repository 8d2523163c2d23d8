"""Hard negatives by exact integer scores, looked up instead of multiplied (Four Russians).

Every component x becomes the integer floor(256 x). An anchor's score with a row is their inner
product. Higher scores come first, ties by smaller id. An anchor's positives are its first rows of
its own label; for each positive the first rows of other labels whose score lies between two shares
of the positive's score are its hard negatives.

Scoring. A candidate's components are cut into bit planes of two's complement, and eight dimensions of
a plane are one byte. For each anchor and each group of eight dimensions a table holds the sums of
all 256 subsets of the anchor's components. A plane's part of the score is the sum over the
groups of the table at the plane's byte; planes are added up by shifting (the top plane counts
negative). So a score takes planes x groups look-ups and no multiplication, and is exact.

Spark. Rows that take part are packed once into a table (id, label, dimensions, planes). Anchors are
the stated query set and are met by all rows in blocks: they go out in waves whose tables take at
most ``WAVE_BYTES`` in a task (the broadcast, without tables, is a thirtieth of that), and a task
scores its candidates block by block, so its memory does not depend on either table. Pass one keeps
for each anchor the first positives a task has seen, pass two the first negatives for each anchor
and positive; both send only those on, and a ranking over these few ends each pass. No label, no
group of equal vectors is ever gathered; in pass one a candidate meets the anchors of its own label only.

Defined results: rows with a null id, a null label, a null vector or any null or non-finite component
take no part; vectors meet only those of their own dimension, and an empty vector scores 0; "other
rows" are those of another id, so copies of the anchor's own row are none of its positives; rows that
share an id are candidates of their own, and every row of an anchor's id is an anchor of its own; a
positive score of 0 admits scores of 0 only, a negative one admits none; an empty table gives no
rows; other columns are ignored. Components whose scores might pass 63 bits raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import arrow_map, written

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 30, 90
WAVE_BYTES = 64_000_000
ANCHORS = 256
CANDIDATES = 2048
FIRST_BLOCK = 64
LAST_ID = (1 << 63) - 1


def quantised(flat: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of doubles, as 64-bit integers."""
    found = np.floor(SCALE * flat)
    if len(found) and np.abs(found).max() >= 1 << 31:
        raise ValueError("components of 2^23 or more are not supported: scores would pass 63 bits")
    return found.astype(np.int64)


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(rows, planes, groups) bytes of two's complement integers (rows, dimensions); the top plane is the sign."""
    rows, dimensions = values.shape
    top = int(max(values.max(initial=0), -values.min(initial=0) - 1, 0)).bit_length()
    out = np.empty((rows, top + 1, -(-dimensions // 8)), np.uint8)
    for plane in range(top + 1):
        out[:, plane] = np.packbits((values >> plane) & 1, axis=1, bitorder="little").reshape(rows, -1)
    return out


def from_planes(planes: np.ndarray, dimensions: int) -> np.ndarray:
    """The integers again."""
    bits = np.unpackbits(planes, axis=2, count=dimensions, bitorder="little") if dimensions else np.zeros((*planes.shape[:2], 0), np.uint8)
    weights = np.int64(1) << np.arange(planes.shape[1], dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.tensordot(bits.astype(np.int64), weights, (1, 0))


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): for eight dimensions the sums over each subset of an anchor's components."""
    n, dimensions = anchors.shape
    groups = -(-dimensions // 8)
    padded = np.zeros((n, groups * 8), kind)
    padded[:, :dimensions] = anchors
    tables = np.zeros((groups, 256, n), kind)
    for group in range(groups):
        for bit in range(8):  # a subset with this top dimension: one without it, plus the component
            tables[group, 1 << bit : 2 << bit] = tables[group, : 1 << bit] + padded[:, group * 8 + bit]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors): from the top plane down, doubled and added up."""
    rows, top, groups = planes.shape
    total = np.zeros((rows, tables.shape[2]), tables.dtype)
    looked_up = np.empty_like(total)
    for plane in range(top - 1, -1, -1):
        total <<= 1
        for group in range(groups):
            np.take(tables[group], planes[:, plane, group], axis=0, out=looked_up, mode="clip")
            if plane == top - 1:
                total -= looked_up
            else:
                total += looked_up
    return total


@dataclass(frozen=True)
class Anchors:
    """Anchors of one dimension: number (over all anchors), id, label, components, and for pass two, by
    positive, the scores between which negatives lie (low above high: none)."""

    number: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def part(self, rows) -> Anchors:
        return Anchors(*[None if x is None else x[rows] for x in (self.number, self.ids, self.labels, self.values, self.low, self.high)])


class _Best:
    """The first ``size`` (score, id) of each of ``keys`` lists: by score downwards, then by id."""

    def __init__(self, keys: int, size: int):
        self.size = size
        self.scores = np.full((keys, size), np.iinfo(np.int64).min)
        self.ids = np.full((keys, size), LAST_ID)
        self.used = np.zeros((keys, size), bool)

    def admits(self, keys, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which scores (candidates, keys) may enter the lists of ``keys``."""
        last, last_id, full = self.scores[keys, -1], self.ids[keys, -1], self.used[keys, -1]
        return ~full | (score > last) | ((score == last) & (ids[:, None] < last_id))

    def add(self, keys: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched, at = np.unique(keys, return_inverse=True)
        held = self.used[touched]
        old = np.repeat(np.arange(len(touched)), held.sum(axis=1))
        key = np.concatenate([old, at])
        score = np.concatenate([self.scores[touched][held], score])
        ids = np.concatenate([self.ids[touched][held], ids])
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        first = rank < self.size
        key, rank = touched[key[first]], rank[first]
        self.scores[key, rank], self.ids[key, rank], self.used[key, rank] = score[first], ids[first], True


def _packed(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """id, label, dimensions, planes of the rows that take part."""
    import pyarrow as pa

    vector = rows[vector_col].cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.select(rows[id_col].cast("long").alias("id"), label.cast("string").alias("label"), vector.alias("vector")).where(
        "id is not null and label is not null and vector is not null"
    ).where(finite)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            sizes = np.diff(vectors.offsets.to_numpy())
            starts = np.cumsum(sizes) - sizes
            flat = quantised(vectors.flatten().to_numpy(zero_copy_only=False))
            data: list[bytes] = [b""] * len(sizes)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                planes = bit_planes(flat[starts[rows][:, None] + np.arange(size)])
                for k, row in enumerate(rows):
                    data[row] = planes[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())],
                names=["id", "label", "dimensions", "planes"],
            )

    return written(arrow_map(usable, pack, "id long, label string, dimensions long, planes binary"), "packed-vectors", "lz4")


def _blocks(batches: Iterator) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(dimensions, ids, labels, planes) of some candidates alike in dimensions and planes, few at first."""
    import pyarrow.compute as pc

    size = FIRST_BLOCK
    for batch in batches:
        ids = batch.column("id").to_numpy()
        labels = batch.column("label").to_numpy(zero_copy_only=False)
        dimensions = batch.column("dimensions").to_numpy()
        data = batch.column("planes")
        lengths = pc.binary_length(data).to_numpy()
        for kind in np.unique(np.stack([dimensions, lengths]), axis=1).T:
            rows = np.flatnonzero((dimensions == kind[0]) & (lengths == kind[1]))
            while len(rows):
                part, rows = rows[:size], rows[size:]
                size = min(CANDIDATES, 2 * size)
                groups = -(-int(kind[0]) // 8)
                planes = np.frombuffer(b"".join(data[int(k)].as_py() for k in part), np.uint8)
                yield int(kind[0]), ids[part], labels[part], planes.reshape(len(part), -1, groups) if groups else np.zeros((len(part), 1, 0), np.uint8)


def _kind(anchors: np.ndarray, planes: np.ndarray) -> type:
    """32-bit sums where no partial sum of a score can pass them."""
    most = int(np.abs(anchors).max(initial=0)) * anchors.shape[1] << planes.shape[1]
    if most >= 1 << 63:
        raise ValueError("components are too large: scores would pass 63 bits")
    return np.int32 if most < 1 << 31 else np.int64


class _Scorer:
    """Scores blocks of candidates against some anchors of one dimension; tables are built once."""

    def __init__(self, anchors: Anchors):
        self.anchors, self._tables = anchors, {}
        self._code = {label: code for code, label in enumerate(dict.fromkeys(anchors.labels))}
        self._codes = np.array([self._code[label] for label in anchors.labels])

    def other_label(self, labels: np.ndarray) -> np.ndarray:
        """(candidates, anchors): whether the labels differ."""
        return np.array([self._code.get(label, -1) for label in labels])[:, None] != self._codes

    def __call__(self, planes: np.ndarray) -> np.ndarray:
        kind = _kind(self.anchors.values, planes)
        if kind not in self._tables:
            self._tables[kind] = subset_sums(self.anchors.values, kind)
        return scores(self._tables[kind], planes)


def _parts(waves: dict[int, Anchors], by_label: bool) -> dict:
    """Scorers of at most ANCHORS anchors: by dimension, or by dimension and label."""
    out: dict = {}
    for dimension, anchors in waves.items():
        order = np.argsort(anchors.labels, kind="stable")
        cuts = np.flatnonzero(anchors.labels[order][1:] != anchors.labels[order][:-1]) + 1 if by_label else []
        for rows in np.split(order, cuts):
            for at in range(0, len(rows), ANCHORS):
                part = anchors.part(rows[at : at + ANCHORS])
                out.setdefault((dimension, part.labels[0]) if by_label else dimension, []).append(_Scorer(part))
    return out


def _hits(best: _Best, where: np.ndarray):
    import pyarrow as pa

    keys, places = np.nonzero(best.used)
    return [pa.array(where[keys]), pa.array(best.scores[keys, places]), pa.array(best.ids[keys, places])]


def _first_positives(packed: DataFrame, waves, positives: int) -> DataFrame:
    """anchor, score, id: of each task the first rows of the anchor's label."""
    import pyarrow as pa

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _parts(waves.value, by_label=True)
        lists = {id(scorer): _Best(len(scorer.anchors.ids), positives) for found in parts.values() for scorer in found}
        for dimension, ids, labels, planes in _blocks(batches):
            by_label: dict[str, list[int]] = {}
            for row, label in enumerate(labels):
                by_label.setdefault(label, []).append(row)
            for label, rows in by_label.items():
                for scorer in parts.get((dimension, label), ()):
                    best, anchors = lists[id(scorer)], scorer.anchors
                    score, own = scorer(planes[rows]), ids[rows]
                    row, key = np.nonzero(best.admits(slice(None), score, own) & (own[:, None] != anchors.ids))
                    if len(row):
                        best.add(key, score[row, key].astype(np.int64), own[row])
        for found in parts.values():
            for scorer in found:
                yield pa.RecordBatch.from_arrays(_hits(lists[id(scorer)], scorer.anchors.number), names=["anchor", "score", "id"])

    return arrow_map(packed, search, "anchor long, score long, id long")


def _first_negatives(packed: DataFrame, waves, positives: int, negatives: int) -> DataFrame:
    """anchor, place (of the positive, from 1), score, id: of each task the first rows within the positive's bounds."""
    import pyarrow as pa

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _parts(waves.value, by_label=False)
        lists = {id(scorer): _Best(len(scorer.anchors.ids) * positives, negatives) for found in parts.values() for scorer in found}
        for dimension, ids, labels, planes in _blocks(batches):
            for scorer in parts.get(dimension, ()):
                best, anchors = lists[id(scorer)], scorer.anchors
                score, n, other = scorer(planes), len(anchors.ids), scorer.other_label(labels)
                for place in range(positives):
                    keys = np.arange(n) + place * n
                    within = (score >= anchors.low[:, place]) & (score <= anchors.high[:, place]) & other
                    row, key = np.nonzero(within & best.admits(keys, score, ids))
                    if len(row):
                        best.add(keys[key], score[row, key].astype(np.int64), ids[row])
        for found in parts.values():
            for scorer in found:
                n = len(scorer.anchors.ids)
                anchor, score, ids = _hits(lists[id(scorer)], np.tile(scorer.anchors.number, positives))
                place, _, _ = _hits(lists[id(scorer)], np.repeat(np.arange(1, positives + 1), n))
                yield pa.RecordBatch.from_arrays([anchor, place, score, ids], names=["anchor", "place", "score", "id"])

    return arrow_map(packed, search, "anchor long, place long, score long, id long")


def _ranked(found: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The first ``size`` of each key with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def _wave(rows: list, bounds: dict | None, positives: int) -> dict[int, Anchors]:
    """Anchor rows as arrays by dimension."""
    by: dict[int, list] = {}
    for row in rows:
        by.setdefault(row["dimensions"], []).append(row)
    out = {}
    for dimension, found in by.items():
        groups = -(-dimension // 8)
        values = np.zeros((len(found), dimension), np.int64)
        for k, row in enumerate(found):
            planes = np.frombuffer(row["planes"], np.uint8).reshape(1, -1, groups) if groups else np.zeros((1, 1, 0), np.uint8)
            values[k] = from_planes(planes, dimension)[0]
        number = np.array([row["anchor"] for row in found], np.int64)
        labels = np.empty(len(found), object)
        labels[:] = [row["label"] for row in found]
        ids = np.array([row["id"] for row in found], np.int64)
        low = high = None
        if bounds is not None:
            low, high = np.ones((len(found), positives), np.int64), np.zeros((len(found), positives), np.int64)
            for k, anchor in enumerate(number.tolist()):
                for place, (least, most) in bounds.get(anchor, {}).items():
                    low[k, place - 1], high[k, place - 1] = least, most
        out[dimension] = Anchors(number, ids, labels, values, low, high)
    return out


def mine(
    rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the column ``id``; ``label`` is what labels are compared by.
    """
    spark = rows.sparkSession
    packed = _packed(rows, id_col, vector_col, label)
    anchors = packed.where(is_anchor).withColumn("anchor", F.monotonically_increasing_id())
    anchors = written(anchors, "anchors")
    # Waves of whole rows up to a number of bytes: a running sum over the anchors' sizes, by file part.
    sized = anchors.select("anchor", (F.col("dimensions") * 256 + 4096 + F.octet_length("label")).alias("bytes"), F.shiftright("anchor", 33).alias("part"))
    shares = sized.groupBy("part").agg(F.sum("bytes").alias("bytes"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a task that wrote anchors
    shares = shares.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("anchor").rowsBetween(Window.unboundedPreceding, 0)
    waves = sized.withColumn("inside", F.sum("bytes").over(inside)).join(shares, "part").select(
        "anchor", F.expr(f"(before + inside) div {wave_bytes}").alias("wave")
    )
    anchors = written(anchors.join(waves, "anchor"), "anchor-waves")
    found = []
    for wave in [r["wave"] for r in anchors.select("wave").distinct().orderBy("wave").collect()]:
        members = anchors.where(F.col("wave") == wave).drop("wave").collect()  # a thirtieth of wave_bytes
        shared = spark.sparkContext.broadcast(_wave(members, None, positives))
        first = written(_ranked(_first_positives(packed, shared, positives), ["anchor"], positives), "positives")
        shared.unpersist()
        bounds: dict[int, dict] = {}
        for r in first.collect():  # a few rows for each anchor of the wave
            if r["score"] >= 0:
                bounds.setdefault(r["anchor"], {})[r["rank"]] = (-(-low * r["score"] // 100), high * r["score"] // 100)
        shared = spark.sparkContext.broadcast(_wave(members, bounds, positives))
        last = written(
            _ranked(_first_negatives(packed, shared, positives, negatives), ["anchor", "place"], negatives), "negatives"
        )
        shared.unpersist()
        of = first.select("anchor", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        found.append(
            last.join(of, ["anchor", "place"]).join(anchors.select("anchor", F.col("id").alias("anchor_id")), "anchor").select(
                "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"),
            )
        )
    if not found:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
