"""Benchmark decontamination by spaced seeds.

A document leaks a benchmark item when they can be laid side by side, word by word, so that some
``WINDOW`` = 13 consecutive words hold at least 80 % equal words (11 of 13); an item of 5 to 12
words must match as a whole with at least 80 %. Words are compared in lower case without
punctuation. Substituted words are tolerated, insertions end an overlap.

Spaced seeds find the places to compare. A mask looks at some positions of a stretch of words and
ignores the others; its hash is the same when the words under it are. Wherever two of 13 words
differ, one of the two masks of ``MASKS`` still fits between them, so no overlap is missed (a test
tries all cases). Short items use a pair of words. Each hit names an item and a shift; the whole
overlap at that shift is then compared.

The benchmark's words are hashed in a Spark job and taken in blocks that close at ``BLOCK_WORDS``
words. A block's hashes are broadcast, meet all documents in one narrow pass, whose finds are
written, and are released before the next block. ``drop_leaks`` then drops all leaking texts by one
anti join over their digests; only rows whose text may be among them are shuffled.

Defined results: null and empty texts, and items of fewer than 5 words, match nothing; equal items
and repeated rows each give their own rows; null ids are kept; an empty table gives no rows; extra
columns are ignored by ``find_leaks`` and kept by ``drop_leaks``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.bloom import marked
from ebbtide.llm.common import arrow_map, free_name, id_and_text, type_name, written
from ebbtide.llm.words import WordHashes, letters_and_digits, mixed

WINDOW = 13
SHARE = 80  # percent
SHORTEST = 5
MASKS = ((0, 1, 3, 5, 6, 7), (0, 1, 4, 7, 9, 10))
SHORT_MASKS = ((0, 1),)
BLOCK_WORDS = 200_000
TABLE_BITS = 16


def _seeds(hashes: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """The mask's hash at every position where it fits."""
    n = len(hashes) - mask[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    key = np.full(n, np.uint64(mask[-1] + 1))
    for k, offset in enumerate(mask):
        key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[offset : offset + n] * np.uint64(2 * k + 3)
    return mixed(key)


class Block:
    """Some items with the sorted seed hashes of all their positions."""

    def __init__(self, items: list[tuple[object, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]
        self.seeds = []
        for masks, short in ((MASKS, False), (SHORT_MASKS, True)):
            for mask in masks:
                keys, item, at = [], [], []
                for k, words in enumerate(self.words):
                    if (len(words) < WINDOW) == short and len(words) >= SHORTEST:
                        found = _seeds(words, mask)
                        keys.append(found)
                        item.append(np.full(len(found), k, np.int64))
                        at.append(np.arange(len(found), dtype=np.int64))
                if keys:
                    keys, item, at = (np.concatenate(x) for x in (keys, item, at))
                    order = np.argsort(keys, kind="stable")
                    table = np.zeros(1 << TABLE_BITS, bool)
                    table[(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
                    self.seeds.append((mask, keys[order], item[order], at[order], table))

    def hits(self, words: np.ndarray) -> set[tuple[int, int]]:
        """(item, shift) pairs: word p of the item may lie on word p + shift of the document."""
        found: set[tuple[int, int]] = set()
        for mask, keys, item, at, table in self.seeds:
            probe = _seeds(words, mask)
            near = np.flatnonzero(table[(probe >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
            if not len(near):
                continue
            low = np.searchsorted(keys, probe[near], "left")
            high = np.searchsorted(keys, probe[near], "right")
            for position, first, last in zip(near[low < high].tolist(), low[low < high].tolist(), high[low < high].tolist()):
                found.update(zip(item[first:last].tolist(), (position - at[first:last]).tolist()))
        return found

    def leaks(self, words: np.ndarray) -> dict[int, tuple[int, int, int, int]]:
        """For each leaked item the best overlap: doc_start, item_start, words, equal words."""
        best: dict[int, tuple[int, int, int, int]] = {}
        for item, shift in sorted(self.hits(words)):
            overlap = self._overlap(words, self.words[item], shift)
            if overlap and (item not in best or (overlap[3], -overlap[0]) > (best[item][3], -best[item][0])):
                best[item] = overlap
        return best

    @staticmethod
    def _overlap(words: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int, int] | None:
        window = min(WINDOW, len(item))
        first, last = max(0, -shift), min(len(item), len(words) - shift)
        if last - first < window:
            return None
        same = item[first:last] == words[first + shift : last + shift]
        sums = np.concatenate([[0], np.cumsum(same)])
        good = np.flatnonzero(100 * (sums[window:] - sums[:-window]) >= SHARE * window)
        if not len(good):
            return None
        a, b = int(good[0]), int(good[-1]) + window
        return first + a + shift, first + a, b - a, int(sums[b] - sums[a])


def _hashes() -> WordHashes:
    return WordHashes(letters_and_digits)


def _words(known: WordHashes, text: str | None) -> np.ndarray:
    hashes = known.hashes((text or "").split())
    return hashes[hashes != 0]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[Block]:
    import pyarrow as pa

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _hashes()
        for batch in batches:
            words = [_words(known, text.as_py()).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], names=["id", "words"])

    texts = id_and_text(benchmark, id_col, text_col)
    schema = f"id {type_name(texts, 'id')}, words binary"
    items, size = [], 0
    for row in written(arrow_map(texts, hashed, schema), "benchmark-words").toLocalIterator():
        items.append((row["id"], np.frombuffer(row["words"], np.uint64)))
        size += len(items[-1][1])
        if size >= block_words:
            yield Block(items)
            items, size = [], 0
    if items:
        yield Block(items)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document and leaked item: its best overlap, in words."""
    import pyarrow as pa

    texts = id_and_text(docs, id_col, text_col)
    item_type = type_name(benchmark, item_col)
    schema = f"`{id_col}` {type_name(texts, 'id')}, `{item_col}` {item_type}, doc_start long, item_start long, n_words long, n_same long"
    arrow_item = pa.array([], pa.int64()).type if item_type in ("bigint", "long") else None

    def against(block):
        def leaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, items = _hashes(), block.value
            for batch in batches:
                at, rows = [], []
                for k, text in enumerate(batch.column(1)):
                    for item, overlap in items.leaks(_words(known, text.as_py())).items():
                        at.append(k)
                        rows.append((items.ids[item], *overlap))
                if rows:
                    item, *numbers = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array(item, arrow_item), *[pa.array(n, pa.int64()) for n in numbers]],
                        names=[id_col, item_col, "doc_start", "item_start", "n_words", "n_same"],
                    )

        return arrow_map(texts, leaks, schema)

    found = []
    for block in _blocks(benchmark, item_col, item_text_col, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        found.append(written(against(shared), "leaks"))
        shared.unpersist()
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, found)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns."""
    import pyarrow as pa

    digest = free_name(docs.columns, "digest")
    texts = docs.select(F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))

    def against(block):
        def leaking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, items = _hashes(), block.value
            for batch in batches:
                read = (text.as_py() for text in batch.column(0))
                found = [hashlib.sha256(text.encode()).digest() for text in read if items.leaks(_words(known, text))]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=[digest])

        return arrow_map(texts, leaking, f"`{digest}` binary")

    found = []
    for block in _blocks(benchmark, item_col, item_text_col, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        found.append(written(against(shared), "leaking"))
        shared.unpersist()
    if not found:
        return docs
    gone = written(reduce(DataFrame.unionByName, found).distinct(), "leaking-texts")
    flag = free_name([*docs.columns, digest], "maybe")
    keyed = docs.withColumn(digest, F.unhex(F.sha2(docs[text_col].cast("string"), 256)))
    near = marked(keyed, digest, gone, flag)
    stay = near.where(F.col(flag)).join(gone, digest, "left_anti").select(*docs.columns)
    return near.where(~F.col(flag)).select(*docs.columns).unionByName(stay)
