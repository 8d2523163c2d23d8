"""N-gram Jaccard self-join with token-combination prefixes.

A document is its set of word shingles; two sets link when their Jaccard similarity is at least
``percent`` / 100. Equal sets are one node. To find the others:

Order. All sets agree on one order of tokens: by frequency level, then hash. Levels come from
counters over all documents; a counter may be shared by several tokens, which blurs the order but
not the result.

Prefixes. A set of n tokens may miss at most t = n - ceil(0.8 n) tokens of a partner. Tokens are
taken in order until every partner must share a signature. A token of the rare class is a
signature by itself. Tokens of the frequent class are dealt into sub-classes by hash, and only
pairs from one sub-class are signatures, so the prefix is extended by one token a sub-class: with
c tokens in a class, an unlucky partner has to miss c - 1 of them to share no pair. It is long
enough when rare tokens + sum over sub-classes (c - 1) > t. The number of sub-classes is a power of
two that grows with n, and pairs are emitted for the coarser classes of the smallest partner, so
both sides emit every pair that the argument needs.

Positions. A rare token also says where it stands in the order of its set. The first token that two
sets share is such a signature, or there is none; no shared token stands before it, so the sets
share at most the tokens from there on. Pairs for which that is too little are not looked at, and
a node leaves a signature when no member is small enough for it.

Verification. Sketches of the sets rule out most pairs that share little; the others are compared
as whole sets, recomputed from the texts. The nodes of a signature that only one node has are done. For the others, each
round compares some pivots of every signature with the members of other components, links those
that verify and contracts; a pivot compared with all members leaves. Signatures whose members are
one component are done, which for groups of near copies is after a round or two: the first pivot
is the member with the largest share of repeated signatures, the original as a rule. The pivots
of a round quadruple, so rounds are few and no pair of a shared signature stays unresolved.

Hashes have 64 bits. Defined results: a text without words, or null, has an empty set and links
with nothing; a null id is no candidate for the smallest id of its component; rows with equal sets,
repeated rows among them, are linked; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.bloom import hash_filter, marked, maybe_in
from ebbtide.llm.common import arrow_map, dropped, free_name, id_and_text, small_batches, type_name, written
from ebbtide.llm.graph import components
from ebbtide.llm.words import grouped, mixed, split_hashes

SHINGLE = 5
PERCENT = 80
CELL_BITS = 20
CELLS_A_ROW = 4096
LEVELS = 4  # an octave
SKETCH_BITS = 2048
BATCH_BYTES = 8_000_000
SEEN_NODES = 200_000


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; of the whole sequence if it is shorter."""
    if not len(words):
        return np.empty(0, np.uint64)
    size, n = min(size, len(words)), max(1, len(words) - size + 1)
    key = np.full(n, np.uint64(size))
    for k in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n] * np.uint64(2 * k + 3)
    return np.unique(mixed(key))


def _sets_of(column, size: int) -> Iterator[np.ndarray]:
    """The shingle sets of the texts of an Arrow column."""
    return (shingles(words, size) for group in grouped(column) for words in split_hashes(group, lower=True))


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def classes(n: int) -> int:
    """Sub-classes of the frequent tokens of a set of n: a power of two, at most n / 8."""
    return 1 << max(0, (n // 8).bit_length() - 1)


def signatures(
    tokens: np.ndarray, levels: np.ndarray, frequent: int, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of a set (single rare tokens, pairs of frequent ones of a sub-class) and how
    many tokens two sets can share whose first common signature this is: for a pair, all of them."""
    n = len(tokens)
    if n < 2:  # only an equal set can be linked to a single token
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    ordered = tokens[np.lexsort((tokens, levels))]
    rare = int((levels < frequent).sum())
    need = n - least_overlap(n, percent) + 1
    if rare >= need:
        return ordered[:need], n - np.arange(need)
    common = ordered[rare:]
    _, first = np.unique(common & np.uint64(classes(n) - 1), return_index=True)
    counts = np.ones(len(common), np.int64)
    counts[first] = 0
    length = int(np.searchsorted(np.cumsum(counts), need - rare)) + 1
    taken = common[:length]
    groups: dict[int, list[int]] = {}
    coarse = classes(least_overlap(n, percent)) - 1
    for token in taken.tolist():
        groups.setdefault(token & coarse, []).append(token)
    pairs = [pair for group in groups.values() for pair in combinations(sorted(group), 2)]
    low, high = np.array(pairs, np.uint64).reshape(-1, 2).T
    both = mixed(low * np.uint64(0x9E3779B97F4A7C15) + high * np.uint64(5))
    return np.concatenate([ordered[:rare], both]), np.concatenate([n - np.arange(rare), np.full(len(both), n)])


def _counters(texts: DataFrame, size: int) -> np.ndarray:
    """For each cell of the token hash, how many (document, token) pairs fall into it."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, held, waiting = np.zeros(1 << CELL_BITS, np.int64), [], 0
        for batch in batches:
            for tokens in _sets_of(batch.column(1), size):
                held.append((tokens >> np.uint64(64 - CELL_BITS)).astype(np.int32))
                waiting += len(held[-1])
                if waiting > 1 << CELL_BITS:
                    cells += np.bincount(np.concatenate(held), minlength=len(cells))
                    held, waiting = [], 0
        if held:
            cells += np.bincount(np.concatenate(held), minlength=len(cells))
        yield _cell_rows({k: row for k, row in enumerate(cells.reshape(-1, CELLS_A_ROW)) if row.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                got = np.frombuffer(data, f"u{len(data) // CELLS_A_ROW}").astype(np.int64)
                sums[row] = sums[row] + got if row in sums else got
        yield _cell_rows(sums)

    def _cell_rows(rows):
        narrow = [row.astype(np.min_scalar_type(row.max())).tobytes() for row in rows.values()]  # 1 to 8 bytes a cell
        return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), pa.array(narrow, pa.binary())], names=["row", "cells"])

    schema = "row long, cells binary"
    counted = arrow_map(texts, count, schema).repartition("row")
    cells = np.zeros((1 << CELL_BITS) // CELLS_A_ROW * CELLS_A_ROW, np.int64).reshape(-1, CELLS_A_ROW)
    with small_batches(texts.sparkSession):
        rows = arrow_map(counted, add, schema).collect()  # bounded by the number of cells
    for row in rows:
        cells[row["row"]] = np.frombuffer(row["cells"], f"u{len(row['cells']) // CELLS_A_ROW}")
    return cells.ravel()


def _sets(texts: DataFrame, levels, frequent: int, size: int, percent: int) -> DataFrame:
    """id, node, n, sketch, signatures, rest of every document; node hashes the whole set, null if it is empty."""
    import pyarrow as pa

    shared = texts.sparkSession.sparkContext.broadcast(levels)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at, rows, held = batch.column(0), [], [], 0
            for k, tokens in enumerate(_sets_of(batch.column(1), size)):
                level = shared.value[(tokens >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                found, rest = signatures(tokens, level, frequent, percent)
                at.append(k)
                rows.append((_node(tokens), len(tokens), _sketch(tokens), found.view(np.int64), rest.astype(np.int32)))
                held += found.nbytes + SKETCH_BITS // 8
                if held > BATCH_BYTES:
                    yield _rows(ids, at, rows)
                    at, rows, held = [], [], 0
            if rows:
                yield _rows(ids, at, rows)

    def _rows(ids, at, rows):
        node, n, sketch, found, rest = zip(*rows)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(at, pa.int64())), pa.array(node, pa.int64()), pa.array(n, pa.int64()),
                pa.array(sketch, pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found), pa.int64())),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rest), pa.int32())),
            ],
            names=["id", "node", "n", "sketch", "signatures", "rest"],
        )

    schema = f"id {type_name(texts, 'id')}, node long, n long, sketch array<long>, signatures array<long>, rest array<int>"
    return written(arrow_map(texts, sets, schema), "shingle-sets", "lz4")


def _node(tokens: np.ndarray) -> int | None:
    if not len(tokens):
        return None
    value = xxhash.xxh3_64_intdigest(tokens.tobytes())
    return value - (1 << 64) if value >> 63 else value


def _sketch(tokens: np.ndarray) -> np.ndarray:
    """A bitmap of the hashed tokens: bits of one set that another lacks count tokens that it lacks."""
    bits = np.zeros(SKETCH_BITS, np.uint8)
    bits[(tokens & np.uint64(SKETCH_BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _token_sets(texts: DataFrame, wanted: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """at, node, text of the rows that may hold wanted nodes, as a table; and (node, at): one of these rows for
    each wanted node. A set goes as its packed text, a fraction of its hashes. Texts are not shuffled to tell
    copies apart."""
    import pyarrow as pa

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int | None] = {None}
        for batch in batches:
            column = batch.column(0).cast("binary")
            nodes, found, held = [], [], 0
            for k, got in enumerate(_sets_of(column, size)):
                node = _node(got)
                if node in seen:  # most copies in one task are one row
                    continue
                if len(seen) > SEEN_NODES:
                    seen = {None}
                seen.add(node)
                nodes.append(node)
                found.append(_packed(column[k].as_py()))
                held += len(found[-1])
                if held > BATCH_BYTES:
                    yield _rows(nodes, found)
                    nodes, found, held = [], [], 0
            if nodes:
                yield _rows(nodes, found)

    def _rows(nodes, found):
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], names=["node", "text"])

    near = maybe_in(texts, "id", wanted).select("text")
    sets = arrow_map(near, packed, "node long, text binary")
    sets = written(sets.select(F.monotonically_increasing_id().alias("at"), "node", "text"), "token-sets", "lz4")
    one = sets.select("node", "at").join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.min("at").alias("at"))
    return sets, written(one, "token-rows")


def _packed(text: bytes) -> bytes:
    import pyarrow as pa

    return len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> bytes:
    import pyarrow as pa

    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def _can_link(percent: int) -> Column:
    """Whether a member can link with another of its signature (``nodes`` of them, least and largest
    ``n``, sums of ``n`` and ``rest``): of two, with the other one, else with one as small as the least."""
    other_n, other_rest = F.col("sum_n") - F.col("n"), F.col("sum_rest") - F.col("rest")
    enough = lambda rest, n: (100 + percent) * rest >= percent * (F.col("n") + n)
    of_two = (100 * F.least("n", other_n) >= percent * F.greatest("n", other_n)) & enough(F.least("rest", other_rest), other_n)
    return F.when(F.col("nodes") == 2, of_two).otherwise(enough(F.col("rest"), F.col("least_n")))


def _shared(sets: DataFrame, percent: int) -> DataFrame:
    """signature, node, n, rest, weight for signatures of two nodes or more, of members that can link there.

    ``weight`` is the number of these signatures that a node has per token: most for an original.
    """
    import pyarrow as pa

    found = sets.where("node is not null").select("node", "n", "signatures", "rest")
    flat = lambda batch: batch.column(2).flatten().to_numpy().view(np.uint64)
    shared = hash_filter(found, lambda batches: (flat(batch) for batch in batches), least=2)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = flat(batch)
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            keep = np.flatnonzero(shared.value.may_hold(keys))
            row = pa.array(np.repeat(np.arange(len(sizes)), sizes)[keep])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[keep].view(np.int64)), batch.column(0).take(row), batch.column(1).take(row),
                    batch.column(3).flatten().take(pa.array(keep)),
                ],
                names=["signature", "node", "n", "rest"],
            )

    maybe = written(arrow_map(found, rows, "signature long, node long, n long, rest int").distinct(), "maybe-members")
    several = maybe.groupBy("signature").agg(
        F.count(F.lit(1)).alias("nodes"), F.min("n").alias("least_n"), F.sum("n").alias("sum_n"), F.sum("rest").alias("sum_rest")
    )
    several = written(several.where("nodes > 1"), "shared-signatures")
    members = written(maybe.join(several, "signature").where(_can_link(percent)).select(maybe.columns), "members")
    dropped(maybe, several)
    weights = written(members.groupBy("node").agg((F.count(F.lit(1)) / F.max("n")).alias("weight")), "weights")
    weighted = written(members.join(weights, "node"), "weighted-members")
    dropped(members, weights)
    return weighted


def _first_pivots(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): the heaviest node of every signature with each of the others."""
    heaviest = written(
        members.groupBy("signature").agg(F.max(F.struct("weight", "node", "n", "rest")).alias("top"))
        .select(
            "signature", F.col("top.node").alias("pivot"), F.col("top.n").alias("pivot_n"),
            F.col("top.rest").alias("pivot_rest"),
        ),
        "pivots",
    )
    found = written(_pairs(members, heaviest, F.lit(True), percent), "pairs")
    dropped(heaviest)
    return found


def _pairs(members: DataFrame, pivots: DataFrame, facing: Column, percent: int) -> DataFrame:
    """Distinct pairs of a member and a pivot whose sizes and positions allow a link.

    J >= p % means that both sizes are within p % and that p / (100 + p) of their sum is shared.
    """
    small, large = F.least("n", "pivot_n"), F.greatest("n", "pivot_n")
    enough = (100 + percent) * F.least("rest", "pivot_rest") >= percent * (F.col("n") + F.col("pivot_n"))
    rows = members.alias("m").join(
        pivots.alias("p"),
        (F.col("m.signature") == F.col("p.signature")) & (F.col("node") != F.col("pivot"))
        & (100 * small >= percent * large) & enough & facing,
    )
    return rows.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches leave a link possible: neither set lacks too many of the other's bits."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    lacking = lambda x, y: F.aggregate(
        F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda total, one: total + one
    )
    near = lambda x, y: 100 * lacking(f"sketch_{x}", f"sketch_{y}") <= (100 - percent) * F.col(f"n_{x}")
    return joined.where(near("a", "b") & near("b", "a")).select("a", "b")


def _verified(pairs: DataFrame, packed: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs that link, from their whole sets: those of the texts that ``rows`` names of ``packed``."""
    import pyarrow as pa

    side = lambda c: rows.select(F.col("node").alias(c), F.col("at").alias(f"at_{c}"))
    text_of = lambda c: packed.select(F.col("at").alias(f"at_{c}"), F.col("text").alias(f"text_{c}"))
    placed = written(pairs.join(side("a"), "a").join(side("b"), "b"), "placed-pairs")
    joined = placed.join(text_of("a"), "at_a").join(text_of("b"), "at_b").select("a", "b", "text_a", "text_b")

    def sets_of(column) -> Iterator[np.ndarray]:
        for data in column:
            (words,) = split_hashes([_unpacked(data.as_py())], lower=True)
            yield shingles(words, size)

    def linking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(sets_of(batch.column(2)), sets_of(batch.column(3))):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = written(arrow_map(joined, linking, "a long, b long"), "links")
    dropped(placed)
    return found


def _links_of(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs that link; sets are recomputed from the texts of the nodes of plausible pairs only."""
    plausible = written(_plausible(pairs, nodes, percent), "plausible")
    ends = plausible.select(F.col("a").alias("node")).unionByName(plausible.select(F.col("b").alias("node"))).distinct()
    wanted = written(nodes.select("node", "id").join(ends, "node", "left_semi"), "wanted")
    packed, rows = _token_sets(texts, wanted, size)
    found = _verified(plausible, packed, rows, size, percent)
    dropped(plausible, wanted, packed, rows)
    return found


def _open(members: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``members`` with their component, of signatures that still have several components.

    A member leaves when even the smallest one is too large for what it can share here.
    """
    roots = labels.select("node", "root")
    labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = written(
        labelled.groupBy("signature")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("n").alias("least_n"))
        .where("low < high").select("signature", "least_n"),
        "open-signatures",
    )
    can_link = (100 + percent) * F.col("rest") >= percent * (F.col("n") + F.col("least_n"))
    left = written(labelled.join(several, "signature").where(can_link).drop("least_n"), "open")
    dropped(several)
    return left


def links(texts: DataFrame, sets: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verified links (a, b) between nodes that give the components, these (node, root), and what is
    left of ``sets`` (id, node, n). Tables are dropped as soon as nothing reads them any more."""
    spark = texts.sparkSession
    members = _shared(sets, percent)
    nodes = written(
        sets.join(members.select("node").distinct(), "node", "left_semi")
        .groupBy("node").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.max("sketch").alias("sketch")),
        "nodes",
    )
    slim = written(sets.select("id", "node", "n"), "sets")
    dropped(sets)
    pairs = _first_pivots(members, percent)
    found = _links_of(pairs, nodes, texts, size, percent)
    labels = components(found) if found.take(1) else spark.createDataFrame([], "node long, root long")
    pivots, held = 4, members
    while True:
        left = _open(members, labels, percent)
        dropped(held)
        if not left.take(1):
            return found, labels, slim
        order = Window.partitionBy("signature").orderBy(F.desc("weight"), F.desc("node"))
        ranked = written(left.withColumn("rank", F.row_number().over(order)), "ranked")
        dropped(left)
        heads = ranked.where(F.col("rank") <= pivots).select(
            "signature", F.col("node").alias("pivot"), F.col("n").alias("pivot_n"), F.col("rest").alias("pivot_rest"),
            F.col("root").alias("pivot_root"), F.col("rank").alias("pivot_rank"),
        )
        facing = (F.col("rank") > F.col("pivot_rank")) & (F.col("root") != F.col("pivot_root"))
        fresh = written(_pairs(ranked, heads, facing, percent).join(pairs, ["a", "b"], "left_anti"), "pairs")
        # A pivot has met every other member of its signature.
        members, held = ranked.where(F.col("rank") > pivots).select("signature", "node", "n", "rest", "weight"), ranked
        pivots *= 4
        if not fresh.take(1):  # nothing to verify, as in most late rounds
            dropped(fresh)
            continue
        pairs = pairs.unionByName(fresh)
        new = _links_of(fresh, nodes, texts, size, percent)
        if new.take(1):
            found = found.unionByName(new)
            labels = components(found)


def similar_sets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id of the component)."""
    texts = id_and_text(docs, id_col, text_col)
    counters = _counters(texts, size)
    levels = np.round(LEVELS * np.log2(np.maximum(counters, 1))).astype(np.uint8)
    # Frequent: in an eighth of all documents or more, and well above what shares a counter.
    floor = max(256 + 4 * counters.mean(), texts.count() / 8)
    frequent = int(np.ceil(LEVELS * np.log2(floor)))
    sets = _sets(texts, levels, frequent, size, percent)
    _, labels, sets = links(texts, sets, size, percent)
    rooted = sets.select("id", "n", "node").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes_ = rooted.where("root is not null").groupBy("root").agg(F.min("id").alias("smallest"))
    named = rooted.join(written(classes_, "components"), "root", "left")
    return named.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("smallest")).alias("component_id"),
    )


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, all columns.

    Rows without words stay, rows of one id stay or go together. Only rows whose id may be among
    those that go are shuffled.
    """
    found = written(similar_sets(docs, id_col, text_col, **options), "similar")
    gone = written(found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct(), "gone")
    flag = free_name(docs.columns, "maybe")
    near = marked(docs, id_col, gone, flag)
    stay = near.where(F.col(flag)).join(gone, id_col, "left_anti").select(*docs.columns)
    return near.where(~F.col(flag)).select(*docs.columns).unionByName(stay)
