"""Substring deduplication with fixed-block anchors, over words.

A window is ``WINDOW`` consecutive words of one document. Every word covered by a window whose
word sequence also starts anywhere else (in the same document too) is removed.

Anchors. Each document is cut into blocks of ``BLOCK`` words, side by side; a window of
2 * BLOCK - 1 words or more holds a whole block, wherever it lies. So a window that repeats has a
block of one document under it that some rolling stretch of ``BLOCK`` words elsewhere equals.

1. Index: the hashes of all blocks, as a filter of bounded size.
2. Probe: every rolling stretch of every document. Blocks, and stretches that the filter may know,
   are counted by hash; those that occur at least twice are the anchors (again a filter).
3. Extend: a hit is extended to every window over it that could repeat: windows are counted by
   their hash, and those with a count of two or more are maximal repeats when joined up.
   Neighbouring windows overlap, so their union is the maximal exact repeat around the hit.

The filters only spare rows: what they let through by mistake is counted exactly afterwards.
Windows are keyed by hash, so no group holds more than one window's places; counts combine before
they are shuffled, and places meet the repeated windows in a join that can be split. Texts are
shuffled only for documents that lose something.

Hashes have 64 bits. What a text loses depends on the text alone, so texts are keyed by their hash
and equal texts are one key in the last join. Defined results: a text without words, or null, has no words
and loses nothing; null ids are kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.bloom import FilterBits, hash_filter, marked
from ebbtide.llm.common import arrow_map, id_and_text, type_name, written
from ebbtide.llm.words import grouped, joined_hashes, mixed

WINDOW = 35
BLOCK = 18
FLUSH_ROWS = 400_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _doubled(words: np.ndarray, size: int) -> list[np.ndarray]:
    """Hashes of 1, 2, 4 ... words in a row, up to ``size``: each from two neighbours of the one before."""
    keys, done = [words], 1
    for _ in range(size.bit_length() - 1):
        key = keys[-1]
        keys.append(mixed(key[:-done] * MULTIPLIER + key[done:] * np.uint64(5)))
        done *= 2
    return keys


def stretches(words: np.ndarray, size: int, starts: np.ndarray | None = None, keys: list[np.ndarray] | None = None) -> np.ndarray:
    """Hashes of ``size`` words in a row, starting at every word (or at ``starts``); ``keys`` are doubled ones."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    keys, out, filled = keys or _doubled(words, size), None, 0
    for bit in range(size.bit_length()):
        if size >> bit & 1:
            part = keys[bit][filled : filled + n] if starts is None else keys[bit][starts + filled]
            out = part if out is None else mixed(out * MULTIPLIER + part * np.uint64(2 * bit + 3))
            filled += 1 << bit
    return out


class Words:
    """The words of some texts one after the other, as hashes."""

    def __init__(self, texts: list[bytes]):
        self.words, self.ends = joined_hashes(texts)
        sizes = np.diff(self.ends, prepend=0)
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.offset = np.arange(len(self.words)) - np.repeat(self.ends - sizes, sizes)
        self.left = np.repeat(sizes, sizes) - self.offset

    def inside(self, size: int) -> np.ndarray:
        """For each start of ``size`` words in a row whether they are of one text."""
        return self.left[: max(0, len(self.words) - size + 1)] >= size

    def blocks(self, size: int) -> np.ndarray:
        """For each start of ``size`` words whether they are a block of their text."""
        whole = self.inside(size)
        return whole & (self.offset[: len(whole)] % size == 0)


def _hashes(found_in: Callable[[Words], np.ndarray]) -> Callable[[Iterator], Iterator[np.ndarray]]:
    """Hashes of the texts in batches, some texts at a time."""
    return lambda batches: (found_in(Words(group)) for batch in batches for group in grouped(batch.column(0)))


def candidate_windows(texts: Words, anchors: FilterBits, block: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows that hold a stretch which may be an anchor."""
    whole = texts.inside(window)
    n = len(whole)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    keys = _doubled(texts.words, window)
    hit = anchors.may_hold(stretches(texts.words, block, keys=keys))
    sums = np.concatenate([[0], np.cumsum(hit)])
    # A window from i holds the stretches from i to i + window - block.
    found = np.flatnonzero((sums[window - block + 1 : window - block + 1 + n] > sums[:n]) & whole)
    return found, stretches(texts.words, window, found, keys)


def repeated_windows(texts: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """text_key, start (in words) of every window whose words also start elsewhere."""
    import pyarrow as pa

    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block wherever it lies")
    def blocks(texts: Words) -> np.ndarray:
        return stretches(texts.words, block, np.flatnonzero(texts.blocks(block)))

    index = hash_filter(texts.select("text"), _hashes(blocks))

    def probes(texts: Words) -> np.ndarray:
        found = stretches(texts.words, block)
        return found[(index.value.may_hold(found) | texts.blocks(block)) & texts.inside(block)]

    anchors = hash_filter(texts.select("text"), _hashes(probes), least=2)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, starts, hashes, size, passed = [], [], [], 0, 0
            for group in grouped(batch.column(0)):
                some = Words(group)
                found, keys = candidate_windows(some, anchors.value, block, window)
                at.append(some.text[found] + passed)
                starts.append(some.offset[found])
                hashes.append(keys)
                size += len(found)
                passed += len(group)
                if size > FLUSH_ROWS:
                    yield _rows(batch, at, starts, hashes)
                    at, starts, hashes, size = [], [], [], 0
            if size:
                yield _rows(batch, at, starts, hashes)

    def _rows(batch, at, starts, hashes):
        at = pa.array(np.concatenate(at))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(1).take(at), pa.array(np.concatenate(starts).astype(np.int32)),
                pa.array(np.concatenate(hashes).view(np.int64)),
            ],
            names=["text_key", "start", "hash"],
        )

    windows = arrow_map(texts.select("text", "text_key"), candidates, "text_key long, start int, hash long")
    repeated = windows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    repeated = written(repeated, "repeated-windows")
    return windows.join(repeated, "hash", "left_semi").select("text_key", "start")


def _runs(starts: list[int], size: int) -> list[tuple[int, int]]:
    """Maximal [first, last) stretches covered by windows of ``size`` from ``starts``."""
    found = np.unique(np.array(starts, np.int64))
    gaps = np.flatnonzero(np.diff(found) > size)
    first = found[np.concatenate([[0], gaps + 1])]
    last = found[np.concatenate([gaps, [len(found) - 1]])] + size
    return list(zip(first.tolist(), last.tolist()))


def removal(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept (the kept words joined by a blank)."""
    import pyarrow as pa

    texts = id_and_text(docs, id_col, text_col).select("id", "text", F.xxhash64("text").alias("text_key"))
    starts = repeated_windows(texts, window, block)
    per_doc = written(starts.groupBy("text_key").agg(F.collect_set("start").alias("starts")), "repeats")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, kept = [], [], []
            starts_of = batch.column(2) if batch.num_columns > 2 else [None] * batch.num_rows
            for text, found in zip(batch.column(1), starts_of):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                totals.append(len(words))
                runs = _runs(found.as_py(), window) if found is not None and found.is_valid else []
                removed.append(sum(last - first for first, last in runs))
                for first, last in reversed(runs):
                    del words[first:last]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                names=["id", "n_words", "n_removed", "kept"],
            )

    schema = f"id {type_name(texts, 'id')}, n_words long, n_removed long, kept string"
    near = marked(texts, "text_key", per_doc)
    touched = near.where("maybe").join(per_doc, "text_key", "left").select("id", "text", "starts")
    alone = near.where("not maybe").select("id", "text")
    return arrow_map(touched, cut, schema).unionByName(arrow_map(alone, cut, schema)).withColumnRenamed("id", id_col)
