"""Suffix-array deduplication of repeated byte strings across documents.

A byte is removed when a string of ``LENGTH`` = 50 bytes that covers it also starts in a document
with a smaller id. Strings are judged on the input.

A suffix array over all text cannot be sorted in one place, so equal strings are brought together
by anchors. The hashes of all ``ANCHOR`` bytes in a row are looked at in windows; the smallest of
each window is an anchor, so every string of 50 bytes holds one, chosen by its content alone.

1. Anchors that occur in one document only are dropped: tasks send 32-bit remainders of their
   distinct anchors, in buckets; what is left becomes a filter of bounded size.
2. Each other occurrence has a context, the bytes that the strings around the anchor can reach.
   A context that also stands in a smaller document is covered as a whole. Tasks solve this among
   their own documents first and send one row per distinct context, which keeps hot passages
   small; the smallest document of each context settles the rest.
3. Where an anchor has several contexts, they share a part only. These contexts, one text each,
   go through a suffix array: two-stage sorting directly sorts only the suffixes that are smaller
   than their successors and induces the others by scanning the buckets; the common prefixes of
   neighbours then group equal strings of 50 bytes, and the smallest document of a group covers
   them in all others.

Rows of one anchor stream through a task in order; a suffix array takes ``SORT_BYTES`` at a time,
and whole anchors. Texts are shuffled only where they lose something.

Hashes have 64 bits (anchors 44 in step 1). Documents are told apart by id and text hash. Defined
results: a null text is empty; a null id counts as larger than any id; rows with the same id do
not cover each other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.bloom import hash_filter, marked
from ebbtide.llm.common import arrow_map, id_and_text, type_name, written
from ebbtide.llm.words import mixed

LENGTH = 50
ANCHOR = 26
STRETCH_BYTES = 2_000_000
FLUSH_ROWS = 500_000
SORT_BYTES = 1_500_000
LAST = np.iinfo(np.int64).max
MULTIPLIER = 0x9E3779B97F4A7C15


def _windows(keys: np.ndarray, size: int, smaller) -> np.ndarray:
    """``smaller`` (np.minimum or np.maximum) over every ``size`` neighbours, by doubling."""
    out, span = keys, 1
    while span * 2 <= size:
        out = smaller(out[:-span], out[span:])
        span *= 2
    rest = size - span
    return smaller(out[:-rest], out[rest:]) if rest else out


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` bytes in a row."""
    key, done, out, filled = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    n = len(data) - size + 1
    for bit in range(size.bit_length()):
        if size >> bit & 1:
            part = key[filled : filled + n]
            out = part.copy() if out is None else out * np.uint64(MULTIPLIER) + part * np.uint64(2 * bit + 3)
            filled += done
        if size >> (bit + 1):
            key = key[:-done] * np.uint64(pow(0xD6E8FEB86659FD93, done, 1 << 64)) + key[done:]
            done *= 2
    return mixed(out)


class Stretch:
    """Some documents back to back, with their anchors."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, anchor: int = ANCHOR):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(text) for text in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.length, self.anchor = length, anchor
        if len(self.data) < length:
            self.places, self.keys = np.empty(0, np.int64), np.empty(0, np.uint64)
        else:
            self.places, self.keys = self._anchors()
        self.doc = np.searchsorted(self.ends, self.places, "right")

    def _anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors: every ``length`` bytes of a document hold one."""
        none = np.uint64(0xFFFFFFFFFFFFFFFF)
        keys = np.minimum(rolling(self.data, self.anchor), none - np.uint64(1))
        for end in self.ends[:-1].tolist():  # no anchor runs over the end of a document
            keys[max(0, end - self.anchor + 1) : end] = none
        span = self.length - self.anchor + 1
        least = _windows(keys, span, np.minimum)
        # A place is chosen when it is the least of some window around it.
        edge = np.zeros(span - 1, np.uint64)
        chosen = _windows(np.concatenate([edge, least, edge]), span, np.maximum) == keys
        places = np.flatnonzero(chosen & (keys != none))
        doc = np.searchsorted(self.ends, places, "right")
        places = places[self.ends[doc] - self.starts[doc] >= self.length]
        return places, keys[places]

    def contexts(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, end and hash of the contexts of the anchors numbered ``at``."""
        places, doc = self.places[at], self.doc[at]
        first = np.maximum(places - (self.length - self.anchor), self.starts[doc])
        last = np.minimum(places + self.length, self.ends[doc])
        out = np.zeros(len(at), np.uint64)
        for size in np.unique(last - first).tolist():
            same = np.flatnonzero(last - first == size)
            padded = np.zeros((len(same), -(-size // 8) * 8), np.uint8)
            padded[:, :size] = np.lib.stride_tricks.sliding_window_view(self.data, size)[first[same]]
            words = padded.view("<u8")
            # Where the anchor lies belongs to the context.
            value = np.uint64(size * 128) + (places[same] - first[same]).astype(np.uint64)
            for column in range(words.shape[1]):
                value = mixed(value * np.uint64(MULTIPLIER) + words[:, column])
            out[same] = value
        return first - self.starts[doc], last - self.starts[doc], out


def two_stage_order(data: np.ndarray, limit: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """The suffixes of ``data`` (uint8, ends with a 0 that is nowhere else) in order of their first ``limit`` bytes.

    A suffix is of type B when it is smaller than its successor, else of type A. Type B is sorted
    directly; scanning the buckets from the left, each suffix in place puts the type A suffix
    before it at the front of its bucket. With ``wanted`` (a mask) only these suffixes are ordered, and
    those that induce them: the ones after a type A suffix, up to the next of type B.
    """
    n = len(data)
    after = np.concatenate([data[1:], [0]]).astype(np.int16)
    difference = np.sign(data.astype(np.int16) - after)
    # The type at a tie is that of the next byte that differs.
    known = np.where(difference != 0, np.arange(n), n)
    next_known = np.minimum.accumulate(known[::-1])[::-1]
    smaller = np.zeros(n, bool)
    smaller[next_known < n] = difference[next_known[next_known < n]] < 0
    smaller[-1] = True  # the end
    if wanted is None:
        wanted = needed = np.ones(n, bool)
    else:
        at = np.arange(n)
        last_wanted = np.maximum.accumulate(np.where(wanted, at, -1))
        last_direct = np.concatenate([[-1], np.maximum.accumulate(np.where(smaller, at, -1))[:-1]])
        needed = last_wanted > last_direct
        needed |= wanted
    direct = np.flatnonzero(smaller & needed)
    direct = direct[_direct_order(data, direct, limit)]
    order = _induced(data, direct, smaller, needed)
    return order[wanted[order]]


def _words_at(padded: np.ndarray, starts: np.ndarray, offset: int) -> np.ndarray:
    """Eight bytes from each start as one big-endian number."""
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))  # eight bytes from each byte on
    return eights[starts + offset].byteswap()


def _direct_order(data: np.ndarray, starts: np.ndarray, limit: int) -> np.ndarray:
    """The order of ``starts`` by their first ``limit`` bytes, eight at a time, ties only."""
    padded = np.concatenate([data, np.zeros(limit + 16, np.uint8)])
    order = np.argsort(_words_at(padded, starts, 0))
    group = np.zeros(len(starts), np.int64)
    keys = _words_at(padded, starts[order], 0)
    group[1:] = np.cumsum(keys[1:] != keys[:-1])
    for offset in range(8, limit, 8):
        sizes = np.bincount(group)
        open_ = np.flatnonzero(sizes[group] > 1)
        if not len(open_):
            break
        keys = _words_at(padded, starts[order[open_]], offset)
        by_key = np.argsort(keys)
        rank = np.empty(len(keys), np.int64)
        rank[by_key] = np.concatenate([[0], np.cumsum(keys[by_key][1:] != keys[by_key][:-1])])
        inner = np.argsort(group[open_] * len(keys) + rank)
        order[open_] = order[open_][inner]
        keys, labels = keys[inner], group[open_][inner]
        new = np.zeros(len(order), bool)
        new[1:] = group[1:] != group[:-1]
        new[open_[1:]] |= (keys[1:] != keys[:-1]) | (labels[1:] != labels[:-1])
        group = np.cumsum(new)
    return order


def _induced(data: np.ndarray, direct: np.ndarray, smaller: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """All needed suffixes in order, from the sorted type B ones."""
    induced = needed & ~smaller
    counts = np.bincount(data[needed], minlength=256)
    ends = np.cumsum(counts)
    heads = ends - counts
    out = np.full(int(ends[-1]), -1, np.int64)
    # Type B fills the back of its bucket, in its order.
    first = data[direct]
    within = np.zeros(len(direct), np.int64)
    for byte in np.unique(first):
        same = np.flatnonzero(first == byte)
        within[same] = ends[byte] - len(same) + np.arange(len(same))
    out[within] = direct
    # Bucket by bucket: what is in place induces type A suffixes of this or a later bucket.
    front = heads.copy()
    for byte in range(256):
        at, end = int(heads[byte]), int(ends[byte])
        while at < end:
            block = out[at:end]
            stop = np.flatnonzero(block < 0)
            size = int(stop[0]) if len(stop) else len(block)
            if not size:
                break
            found = block[:size] - 1
            found = found[found >= 0]
            found = found[induced[found]]
            targets = data[found]
            for target in np.unique(targets):
                same = found[targets == target]
                out[front[target] : front[target] + len(same)] = same
                front[target] += len(same)
            at += size
    return out


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Whether each suffix in order shares its first ``limit`` bytes with the one before."""
    padded = np.concatenate([data, np.zeros(limit + 16, np.uint8)])
    same = np.ones(len(order), bool)
    same[0] = False
    for offset in range(0, limit, 8):
        open_ = np.flatnonzero(same)
        a, b = _words_at(padded, order[open_], offset), _words_at(padded, order[open_ - 1], offset)
        if limit - offset < 8:
            shift = np.uint64(8 * (8 - limit + offset))
            a, b = a >> shift, b >> shift
        same[open_[a != b]] = False
    return same


def repeated_strings(texts: list[bytes], owners: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(text, start) of every string of ``length`` bytes that also starts in a text of a smaller owner.

    Bytes are raised by one and text ends are zeros, so no string runs over an end. UTF-8 has no
    byte 255, so raised bytes stay bytes.
    """
    sizes = np.array([len(text) for text in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    data = np.zeros(int(sizes.sum()) + len(texts), np.uint8)
    raised = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8) + np.uint8(1)
    data[:] = raised
    data[starts + sizes] = 0
    text_of = np.repeat(np.arange(len(texts)), sizes + 1)
    inside = np.arange(len(data)) - starts[text_of] + length <= sizes[text_of]
    if not inside.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = two_stage_order(data, length, inside)
    group = np.cumsum(~common_prefixes(data, order, length)) - 1
    least = np.full(int(group[-1]) + 1, LAST)
    owner = owners[text_of[order]]
    np.minimum.at(least, group, owner)
    found = order[owner > least[group]]
    return text_of[found], found - starts[text_of[found]]


def _stretches(batches, length: int, anchor: int) -> Iterator[tuple[Stretch, np.ndarray, np.ndarray]]:
    """Documents in stretches of some megabytes, with their order keys and text keys."""
    texts, owners, keys, size = [], [], [], 0
    for batch in batches:
        for owner, text, key in zip(*[column.to_pylist() for column in batch.columns]):
            texts.append(text.encode("utf-8", "surrogatepass"))
            owners.append(owner)
            keys.append(key)
            size += len(texts[-1])
            if size >= STRETCH_BYTES:
                yield Stretch(texts, length, anchor), np.array(owners, np.int64), np.array(keys, np.int64)
                texts, owners, keys, size = [], [], [], 0
    if texts:
        yield Stretch(texts, length, anchor), np.array(owners, np.int64), np.array(keys, np.int64)


def _shared_anchors(texts: DataFrame, length: int, anchor: int):
    """A broadcast filter of the anchors that occur at least twice."""
    return hash_filter(texts, lambda batches: (s.keys for s, _, _ in _stretches(batches, length, anchor)), least=2)


SPAN_BITS = 8  # a span is its first byte and its size, in one number


def _span(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (first.astype(np.int64) << SPAN_BITS) | (last - first)


def _longs(names: list[str], *columns):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c, np.int64)) for c in columns], names=names)


def _least_by(keys: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """For each row the least owner among the rows with its key."""
    _, group = np.unique(keys, return_inverse=True)
    least = np.full(int(group.max()) + 1 if len(group) else 0, LAST)
    np.minimum.at(least, group, owners)
    return least[group]


ROW = ["anchor", "context", "owner", "text_key", "span", "solved"]


def _context_rows(texts: DataFrame, shared, length: int, anchor: int) -> DataFrame:
    """Rows of ROW: spans that a task could solve itself, else one row a context for its least owner."""

    def rows(batches):
        held, size = [], 0
        for stretch, owners, keys in _stretches(batches, length, anchor):
            at = np.flatnonzero(shared.value.may_hold(stretch.keys))
            first, last, hashes = stretch.contexts(at)
            doc = stretch.doc[at]
            held.append((stretch.keys[at].view(np.int64), hashes.view(np.int64), owners[doc], keys[doc], _span(first, last)))
            size += len(at)
            if size > FLUSH_ROWS:
                yield _solve(held)
                held, size = [], 0
        if size:
            yield _solve(held)

    def _solve(held):
        key, context, owner, text_key, span = (np.concatenate(x) for x in zip(*held))
        solved = owner > _least_by(context, owner)
        # A solved row may go anywhere: its own hash spreads it.
        return _longs(ROW, np.where(solved, span * 31 + text_key, key), context, owner, text_key, span, solved.astype(np.int64))

    return arrow_map(texts, rows, ", ".join(f"{name} long" for name in ROW))


def _settled(rows: DataFrame) -> DataFrame:
    """Rows of ROW after all tasks met: solved spans, and open ones of anchors with several contexts."""

    def settle(batches):
        tail, before = None, None  # open rows of the last anchor; (context, anchor, least owner) of the last row
        for batch in batches:
            key, context, owner, text_key, span, solved = (c.to_numpy() for c in batch.columns)
            done = solved == 1
            if done.any():
                yield _longs(ROW, *[x[done] for x in (key, context, owner, text_key, span, solved)])
            key, context, owner, text_key, span = (x[~done] for x in (key, context, owner, text_key, span))
            if not len(key):
                continue
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (context[1:] != context[:-1])
            group = np.cumsum(new) - 1
            least = owner[np.flatnonzero(new)]
            if before is not None and before[:2] == (key[0], context[0]):
                least[0] = before[2]
            before = (key[-1], context[-1], least[-1])
            covered = owner > least[group]
            if covered.any():
                yield _longs(ROW, *[x[covered] for x in (key, context, owner, text_key, span)], np.ones(covered.sum()))
            fresh = tuple(x[~covered] for x in (key, context, owner, text_key, span))
            rows_ = fresh if tail is None else tuple(np.concatenate(pair) for pair in zip(tail, fresh))
            if not len(rows_[0]):
                continue
            cut = int(np.argmax(rows_[0] == rows_[0][-1]))
            if cut:
                yield from _several(tuple(x[:cut] for x in rows_))
            tail = tuple(x[cut:] for x in rows_)
        if tail is not None:
            yield from _several(tail)

    def _several(rows_):
        key, context = rows_[:2]
        start = np.ones(len(key), bool)
        start[1:] = key[1:] != key[:-1]
        group = np.cumsum(start) - 1
        other = np.zeros(len(key), bool)
        other[1:] = ~start[1:] & (context[1:] != context[:-1])
        several = np.bincount(group, other)[group] > 0
        if several.any():
            yield _longs(ROW, *[x[several] for x in rows_], np.zeros(several.sum()))

    ordered = rows.repartition("anchor").sortWithinPartitions("anchor", "context", "owner")
    return written(arrow_map(ordered, settle, ", ".join(f"{name} long" for name in ROW)), "contexts")


def _sorted_out(texts: DataFrame, open_rows: DataFrame, length: int) -> DataFrame:
    """owner, text_key, span of what the suffix arrays of the open contexts cover."""
    import pyarrow as pa

    places = open_rows.groupBy("text_key", "owner").agg(F.collect_list(F.struct("anchor", "span")).alias("spans"))
    places = written(places, "open-places")
    near = marked(texts, "text_key", places).where("maybe").select("owner", "text", "text_key")
    joined = near.join(places, ["text_key", "owner"]).select("owner", "text", "text_key", "spans")
    # Equal rows are one document here.
    joined = joined.dropDuplicates(["text_key", "owner"])

    def cut(batches):
        for batch in batches:
            held, size = ([], [], [], [], []), 0
            for owner, text, key, spans in zip(*batch.columns):
                data = text.as_py().encode("utf-8", "surrogatepass")
                for one in spans.as_py():
                    first, width = one["span"] >> SPAN_BITS, one["span"] & ((1 << SPAN_BITS) - 1)
                    row = (one["anchor"], owner.as_py(), key.as_py(), first, data[first : first + width])
                    for column, value in zip(held, row):
                        column.append(value)
                    size += width
                if size > SORT_BYTES:
                    yield _contexts(held)
                    held, size = ([], [], [], [], []), 0
            if held[0]:
                yield _contexts(held)

    def _contexts(held):
        return pa.RecordBatch.from_arrays(
            [*[pa.array(x, pa.int64()) for x in held[:4]], pa.array(held[4], pa.binary())],
            names=["anchor", "owner", "text_key", "first", "bytes"],
        )

    def sort(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                if size > SORT_BYTES and row[0] != held[-1][0]:
                    yield from _covered(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield from _covered(held)

    def _covered(held):
        _, owners, keys, firsts, pieces = zip(*held)
        owners, keys, firsts = (np.array(x, np.int64) for x in (owners, keys, firsts))
        text, start = repeated_strings(list(pieces), owners, length)
        if len(text):
            first = firsts[text] + start
            yield _longs(["owner", "text_key", "span"], owners[text], keys[text], _span(first, first + length))

    found = arrow_map(joined, cut, "anchor long, owner long, text_key long, first long, bytes binary")
    ordered = found.repartition("anchor").sortWithinPartitions("anchor")
    return written(arrow_map(ordered, sort, "owner long, text_key long, span long").distinct(), "sorted-out")


def removal(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, spans (removed [first, last) bytes), kept (binary)."""
    import pyarrow as pa

    plain = id_and_text(docs, id_col, text_col)
    owner = F.coalesce(F.col("id").cast("long"), F.lit(int(LAST)))
    keyed = plain.select("id", owner.alias("owner"), "text", F.xxhash64("text").alias("text_key"))
    texts = keyed.select("owner", "text", "text_key")
    shared = _shared_anchors(texts, length, anchor)
    settled = _settled(_context_rows(texts, shared, length, anchor))
    sorted_out = _sorted_out(texts, settled.where("solved = 0"), length)
    spans = settled.where("solved = 1").select("owner", "text_key", "span").unionByName(sorted_out)
    per_doc = written(spans.groupBy("text_key", "owner").agg(F.collect_set("span").alias("spans")), "removed")

    def cut(batches):
        for batch in batches:
            rows, held = ([], [], [], []), 0
            at = 0
            spans_of = batch.column(2) if batch.num_columns > 2 else [None] * batch.num_rows
            for text, found in zip(batch.column(1), spans_of):
                data = text.as_py().encode("utf-8", "surrogatepass")
                runs = _runs(found.as_py()) if found is not None and found.is_valid else []
                edges = [0, *[edge for run in runs for edge in run], len(data)]
                kept = b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2])])
                row = (len(data), len(data) - len(kept), [{"first": a, "last": b} for a, b in runs], kept)
                for column, value in zip(rows, row):
                    column.append(value)
                held += len(data)
                if held > SORT_BYTES:
                    yield _cut_rows(batch.column(0).slice(at, len(rows[0])), rows)
                    at, rows, held = at + len(rows[0]), ([], [], [], []), 0
            if rows[0]:
                yield _cut_rows(batch.column(0).slice(at, len(rows[0])), rows)

    span_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def _cut_rows(ids, rows):
        n, removed, found, kept = rows
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(found, span_type), pa.array(kept, pa.binary())],
            names=["id", "n_bytes", "n_removed", "spans", "kept"],
        )

    schema = f"id {type_name(plain, 'id')}, n_bytes long, n_removed long, spans array<struct<first:long,last:long>>, kept binary"
    near = marked(keyed, "text_key", per_doc)
    touched = near.where("maybe").join(per_doc, ["text_key", "owner"], "left").select("id", "text", "spans")
    alone = near.where("not maybe").select("id", "text")
    return arrow_map(touched, cut, schema).unionByName(arrow_map(alone, cut, schema)).withColumnRenamed("id", id_col)


def _runs(spans: list[int]) -> list[tuple[int, int]]:
    """Maximal removed runs."""
    out: list[tuple[int, int]] = []
    for span in sorted(spans):
        first = span >> SPAN_BITS
        last = first + (span & ((1 << SPAN_BITS) - 1))
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out
