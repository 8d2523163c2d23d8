import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ebbtide.llm import merkle
from ebbtide.llm.common import lower_ascii
from ebbtide.llm.queries import MANIFEST_CELLS, _tampered_with, op13_merkle_manifest
from tests.llm import brute


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(cells):
    return digest(*["-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells])


def levels(nodes, fan):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][k : k + fan]) for k in range(0, len(out[-1]), fan)])
    return out


def climb(tree, at, value, fan):
    siblings = []
    for row in tree[:-1]:
        first = at - at % fan
        left, right = row[first:at], row[at + 1 : first + fan]
        siblings += left + right
        value, at = digest(*left, value, *right), at // fan
    return value, siblings


def manifest(rows, cells, group, ident, changed, fan=8):
    """(id, leaf, subroot, root, proof, folded root, verified) of every row; ``rows`` are dicts."""
    groups = {}
    for row in rows:
        groups.setdefault(row[group], []).append((row[ident] is not None, row[ident] or 0, leaf([row[c] for c in cells]), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fan) for g in order}
    top = levels([trees[g][-1][0] for g in order], fan)
    out = []
    for place, g in enumerate(order):
        for at, (_, _, own, row) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            value, low = climb(trees[g], at, leaf([changed(row)[c] for c in cells]), fan)
            value, high = climb(top, place, value, fan)
            out.append((row[ident], own, trees[g][-1][0], top[-1][0], "".join(low + high), value, value == top[-1][0]))
    return sorted(out, key=brute.key)


def lowered(row):
    if row["doc_id"] is None or zlib.crc32(str(row["doc_id"]).encode()) % 3 or row["text"] is None:
        return row
    return row | {"text": "".join(c.lower() if "A" <= c <= "Z" else c for c in row["text"])}


def found(df, fan=8, height=4):
    tampering = merkle.Tampering(_tampered_with(df["doc_id"]), {"text": lower_ascii(df["text"])})
    return merkle.folded(df, "doc_id", "lang", MANIFEST_CELLS, tampering, fan, height)


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=brute.key)


#: An id that the query tampers with.
TAMPERED = next(k for k in range(20, 99) if zlib.crc32(str(k).encode()) % 3 == 0)


def odd(spark):
    cells = [
        (TAMPERED, "A Text", "en", "s", 6), (2, "text", "en", None, None), (2, "text", "en", None, None), (2, "Other", "en", "x", 1),
        (None, None, "en", "s", 0), (None, "Z", None, "s", 0), (5, "", None, None, None), (6, "Ünï ÀB", "", "s", 3),
        (-7, "X" * 200_000, "zz", "s", 1), (9, "É", "é", "s", 1), (10, "q", "\U0001f600", "s", 1), (11, "q", "-", "s", 1), (12, "q", "=", "s", 1),
        ((1 << 62) + 1, "Long Id", "en", "s", 1),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, id string, at int, tree string, `Block` int"
    return spark.createDataFrame([c + ("i", 0, "t", 4) for c in cells], names).repartition(3)


@pytest.mark.parametrize(("fan", "height"), [(8, 4), (2, 1), (3, 2)])
def test_manifest_of_odd_rows(spark, fan, height):
    docs = odd(spark)
    plain = [r.asDict() for r in docs.collect()]
    got = rows(found(docs, fan, height))
    assert got == manifest(plain, MANIFEST_CELLS, "lang", "doc_id", lowered, fan)
    assert {r[-1] for r in got} == {True, False}


def test_query(spark, sf_dir, documents):
    plain = [r.asDict() for r in documents.collect()]
    expected = [r[:4] + (digest(r[4]),) + r[5:] for r in manifest(plain, MANIFEST_CELLS, "lang", "doc_id", lowered)]
    assert rows(op13_merkle_manifest(spark, sf_dir)) == sorted(expected, key=brute.key)


@pytest.mark.parametrize("n", [1, 8, 9, 65])
def test_sizes_at_the_edges_of_blocks(spark, n):
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("One").alias("text"), F.lit("x").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(1).alias("n_chars")
    )
    plain = [r.asDict() for r in docs.collect()]
    assert rows(found(docs, 8, 1)) == manifest(plain, MANIFEST_CELLS, "lang", "doc_id", lowered)


def test_without_tampering_all_is_verified(spark):
    got = merkle.folded(odd(spark), "doc_id", "lang", MANIFEST_CELLS)
    assert got.where("verified and folded_root = root").count() == 14


def test_no_rows(spark):
    assert found(odd(spark).limit(0)).count() == 0


def test_midstates_resume_where_the_child_stood():
    nodes = [digest(str(k)) for k in range(70)]
    tree = merkle.MidstateTree(nodes, 8, 3)
    assert tree.top == levels(nodes, 8)[-1][0]
    for at in (0, 7, 8, 63, 69):
        changed = nodes[:at] + [digest("new")] + nodes[at + 1 :]
        assert tree.fold(at, digest("new").encode()).decode() == levels(changed, 8)[-1][0]
