"""A Merkle manifest of a table: every row a leaf, a tree a group, a root over the groups' roots.

A leaf is the SHA-256 of the row's chosen columns, each ``-`` if null, else its UTF-8 byte count,
``:`` and the value. Per group the leaves stand in order of their id; while several nodes remain,
every ``FAN`` consecutive ones become the SHA-256 of their digests (as hex text, joined). What
remains is the group's subroot; the subroots, in order of the group (null first, then UTF-8
bytewise), give the root in the same way.

Midstates. Hashing a parent from left to right passes through a state before each child slot; the
tree keeps a copy of each. To fold a replaced child upwards, the state of its slot is resumed with
the replacement and the right siblings alone: what stands to the left is never hashed again.

Spark. Leaves are hashed by SQL functions. Ranks come from a range sort whose partitions are
counted, not from one window a group, so a group may hold any share of the rows. Nodes are dealt out
in blocks of ``FAN ** LEVELS`` consecutive ones of a tree, whatever the tree's size; a task builds
``LEVELS`` levels of one block at a time. The blocks' roots are the nodes of the next round, so a
round shrinks the table 4096 times and the loop ends after log(rows) / log(4096) rounds. Every block
then gets the siblings of its way up as one row (a cogroup by block), and its leaves are folded in
the task that holds their block's states.

Defined results: null cells are ``-``; a null group is a group by itself and comes first; a null id
comes first in its group; rows of one id stand in order of their leaf; equal rows are leaves of their own; an empty table gives no rows; other
columns are ignored, whatever their names; a very long cell costs what its hash costs, as texts never leave
the first job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import type_name, written
from ebbtide.session import drop_table

FAN = 8
LEVELS = 4  # in a block: 4096 nodes
NODE = "tree string, at long, nodes long, digest string"
WAY = "array<struct<left: string, right: string>>"


def leaf_digest(cells: Sequence[Column]) -> Column:
    """SHA-256 of the cells in order, as lower-case hex."""
    parts = []
    for cell in cells:
        value = cell.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class MidstateTree:
    """Up to ``levels`` levels over some nodes, with the hash state before each child slot."""

    def __init__(self, digests: Sequence[str], fan: int, levels: int):
        self.fan, self.rows, self.states = fan, [[d.encode() for d in digests]], []
        for _ in range(levels):
            row, states, up = self.rows[-1], [], []
            for first in range(0, len(row), fan):
                state = hashlib.sha256()
                for child in row[first : first + fan]:
                    states.append(state.copy())
                    state.update(child)
                up.append(state.hexdigest().encode())
            self.states.append(states)
            self.rows.append(up)

    @property
    def top(self) -> str:
        return self.rows[-1][0].decode()

    def siblings(self, at: int) -> Iterator[tuple[bytes, bytes]]:
        """What stands left and right of the way from node ``at``, level by level."""
        for row in self.rows[:-1]:
            first = at - at % self.fan
            yield b"".join(row[first:at]), b"".join(row[at + 1 : first + self.fan])
            at //= self.fan

    def fold(self, at: int, digest: bytes) -> bytes:
        """The top if node ``at`` had ``digest``."""
        for row, states in zip(self.rows, self.states):
            state = states[at].copy()
            state.update(digest)
            for right in row[at + 1 : at - at % self.fan + self.fan]:
                state.update(right)
            digest = state.hexdigest().encode()
            at //= self.fan
        return digest


def _levels(nodes: int, fan: int, levels: int) -> int:
    """Levels of a block in a tree of so many nodes: until one node is left, at most ``levels``."""
    done = 0
    while nodes > 1 and done < levels:
        nodes, done = -(-nodes // fan), done + 1
    return done


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (tree, ...) with ``at``, the rank in their tree by ``order``, and ``nodes``, its size.

    Rows are range-sorted and written; the partitions' shares of each tree are counted and summed
    up, which takes a row per partition and tree, and added to the rank within the partition.
    """
    place = F.monotonically_increasing_id()
    ordered = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ordered = written(ordered.withColumn("place", place), "merkle-sorted")
    ordered = ordered.withColumn("part", F.shiftright("place", 33))
    shares = ordered.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    shares = shares.select(
        "tree", "part",
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("nodes"),
    )
    shares = written(shares, "merkle-shares")
    return ordered.join(shares, ["tree", "part"]).withColumn("at", F.col("place") + F.col("shift")).drop("place", "part", "shift")


def _blocks(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"at div {fan ** levels}"))


def _tree(table, fan: int, levels: int) -> MidstateTree:
    """The tree over the nodes of one block, which stand in order."""
    return MidstateTree(table.column("digest").to_pylist(), fan, _levels(table.column("nodes")[0].as_py(), fan, levels))


def _tops(blocks: DataFrame, fan: int, levels: int) -> DataFrame:
    """The root of every block as a node: tree, at (the block's number), nodes (blocks of the tree), digest."""
    import pyarrow as pa

    size, schema = fan**levels, pa.schema([("tree", pa.string()), ("at", pa.int64()), ("nodes", pa.int64()), ("digest", pa.string())])

    def top(key, table):
        table = table.sort_by("at")
        found = dict(
            tree=key[0].as_py(), at=key[1].as_py(), nodes=-(-table.column("nodes")[0].as_py() // size), digest=_tree(table, fan, levels).top
        )
        return pa.Table.from_pylist([found], schema)

    return blocks.groupBy("tree", "block").applyInArrow(top, NODE)


def ways(nodes: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """tree, at, root, way: the root of each node's tree and the siblings on the way there."""
    import pyarrow as pa

    blocks = written(_blocks(nodes.select("tree", "at", "nodes", "digest"), fan, levels), "merkle-nodes")
    tops = written(_tops(blocks, fan, levels), "merkle-tops")
    if tops.where("nodes > 1").limit(1).count():
        above = ways(tops, fan, levels)
    else:
        above = tops.select("tree", "at", F.col("digest").alias("root"), F.from_json(F.lit("[]"), WAY).alias("way"))
    step = pa.struct([("left", pa.string()), ("right", pa.string())])
    schema = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("root", pa.string()), ("way", pa.list_(step))])

    def down(key, table, upper):
        table, upper = table.sort_by("at"), upper.to_pylist()[0]
        tree = _tree(table, fan, levels)
        found = [
            {
                "tree": key[0].as_py(), "at": at, "root": upper["root"],
                "way": [dict(left=a.decode(), right=b.decode()) for a, b in tree.siblings(k)] + upper["way"],
            }
            for k, at in enumerate(table.column("at").to_pylist())
        ]
        return pa.Table.from_pylist(found, schema)

    return written(
        blocks.groupBy("tree", "block").cogroup(above.withColumnRenamed("at", "block").groupBy("tree", "block"))
        .applyInArrow(down, f"tree string, at long, root string, way {WAY}"),
        "merkle-ways",
    )


@dataclass(frozen=True)
class Tampering:
    """Where ``when`` holds, the columns named in ``cells`` have these values instead."""

    when: Column
    cells: dict[str, Column]


def folded(
    rows: DataFrame, id_col: str, group_col: str, cells: Sequence[str], tampering: Tampering | None = None,
    fan: int = FAN, levels: int = LEVELS,
) -> DataFrame:
    """One row per row: id, leaf, subroot, root, proof, folded_root, verified.

    ``folded_root`` is what the leaf, or the leaf of the tampered row, leads to with the siblings of
    the tree as built. ``proof`` joins the digests of these siblings as text, level by level via the
    subroot to the root, left to right.
    """
    import pyarrow as pa

    group = rows[group_col].cast("string")
    digest = leaf_digest([rows[c] for c in cells])
    if tampering:
        other = leaf_digest([tampering.cells.get(c, rows[c]) for c in cells])
        other = F.when(F.coalesce(tampering.when, F.lit(False)), other)
    leaves = rows.select(
        # Names of trees sort like groups: the null group before all others, then bytewise.
        F.when(group.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), group)).alias("tree"),
        rows[id_col].alias("id"), digest.alias("digest"),
        (other if tampering else F.lit(None).cast("string")).alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written, as the range sort samples its input: texts are hashed once. ``row`` spreads equal rows.
    hashed = written(leaves, "merkle-leaves")
    placed = written(_blocks(ranked(hashed, ["id", "digest", "row"]), fan, levels).drop("row"), "merkle-placed")
    drop_table(hashed)

    subways = ways(written(_tops(placed, fan, levels), "merkle-block-tops"), fan, levels)
    subroots = subways.where("at = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    groups = written(ranked(written(subroots, "merkle-subroots"), ["name"]), "merkle-groups")
    over = ways(groups, fan, levels).join(groups.select("at", "name"), "at").select(
        F.col("name").alias("tree"), F.col("root").alias("whole"), F.col("way").alias("over")
    )
    above = written(
        subways.join(over, "tree").select(
            "tree", F.col("at").alias("block"), F.col("root").alias("subroot"), F.col("whole").alias("root"),
            F.concat("way", "over").alias("way"),
        ),
        "merkle-above",
    )
    names = ["id", "leaf", "subroot", "root", "proof", "folded_root", "verified"]
    schema = f"id {type_name(rows, id_col)}, leaf string, subroot string, root string, proof string, folded_root string, verified boolean"

    def fold(key, table, upper):
        table, upper = table.sort_by("at"), upper.to_pylist()[0]
        tree, root = _tree(table, fan, levels), upper["root"]
        # Above the block the way is the same for all its leaves, and so are the resumed states.
        steps = [(hashlib.sha256(step["left"].encode()), step["right"].encode()) for step in upper["way"]]
        beyond = "".join(step["left"] + step["right"] for step in upper["way"])
        proofs, roots = [], []
        for k, (leaf, changed) in enumerate(zip(table.column("digest").to_pylist(), table.column("changed").to_pylist())):
            found = tree.fold(k, (changed or leaf).encode())
            for before, right in steps:
                state = before.copy()
                state.update(found)
                state.update(right)
                found = state.hexdigest().encode()
            roots.append(found.decode())
            proofs.append(b"".join(x for pair in tree.siblings(k) for x in pair).decode() + beyond)
        n = len(roots)
        return pa.Table.from_arrays(
            [
                table.column("id"), table.column("digest"), pa.array([upper["subroot"]] * n, pa.string()), pa.array([root] * n, pa.string()),
                pa.array(proofs, pa.string()), pa.array(roots, pa.string()), pa.array([x == root for x in roots], pa.bool_()),
            ],
            names=names,
        )

    return (
        placed.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(fold, schema)
        .withColumnRenamed("id", id_col)
    )
