import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import hard_negatives as hn
from tests.llm import brute


def plain(rows, anchor, positives=5, negatives=10):
    """rows: (id, vector, label); the contract as two sorts."""
    usable = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((i, [math.floor(256 * x) for x in vector], label))
    out = []
    for i, own, label in usable:
        if not anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(own, v)), j, other) for j, v, other in usable if len(v) == len(own)]
        first = sorted((s, j) for s, j, other in scored if other == label and j != i)[:positives]
        for s, positive in first:
            found = sorted((t, j) for t, j, other in scored if other != label and -30 * s <= -100 * t <= -90 * s)
            out += [(i, positive, rank + 1, j, -s, -t) for rank, (t, j) in enumerate(found[:negatives])]
    return sorted(out, key=brute.key)


def mined(df, divisor=100, **options):
    return sorted([tuple(r) for r in hn.mine(df, F.col("id") % divisor == 0, df["label"], **options).collect()], key=brute.key)


SCHEMA = "vec_id long, embedding array<float>, label int, id string, planes int, anchor int"


def vectors(spark, seed, n=260, dimensions=20, labels=4, copies=0.3):
    rng = random.Random(seed)
    f32 = lambda x: float(np.float32(x))
    rows, center = [], [[rng.gauss(0, 0.3) for _ in range(dimensions)] for _ in range(3)]
    for k in range(n):
        base = rng.choice(center)
        vector = [f32(x + rng.gauss(0, 0.1)) for x in base] if rng.random() > copies else [f32(x) for x in center[0]]
        rows.append((k, vector, rng.randrange(labels)))
    rows += [
        (None, rows[0][1], 1), (1000, None, 1), (1010, rows[0][1], None), (1020, [0.5, None] * 10, 1), (1030, [math.nan] * 20, 1),
        (1040, [math.inf] + [0.1] * 19, 1), (1050, [], 1), (1051, [], 1), (1052, [], 2), (1060, [0.5, -0.5, 1.0], 2), (1061, [0.5, -0.5, 0.9], 2),
        (1062, [0.25, -0.25, 0.6], 3), (20, rows[20][1], rows[20][2]), (20, rows[20][1], rows[20][2]), (-30, rows[0][1], 0), (1070, [-9.5] * 20, 1),
    ]
    rng.shuffle(rows)
    return rows, spark.createDataFrame([r + ("x", 0, 1) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize(("seed", "options"), [(1, {}), (2, {"wave_bytes": 40_000}), (3, {"positives": 2, "negatives": 3})])
def test_same_as_plain_sorts(spark, monkeypatch, seed, options):
    monkeypatch.setattr(hn, "ANCHORS", 5)
    rows, df = vectors(spark, seed)
    assert mined(df, 10, **options) == plain(
        rows, lambda i: i % 10 == 0, **{k: v for k, v in options.items() if k != "wave_bytes"}
    )


def test_no_rows(spark):
    _, df = vectors(spark, 1)
    assert mined(df.limit(0)) == [] and mined(df.where("label is null")) == []


def test_scores_are_inner_products():
    rng = np.random.default_rng(5)
    for dimensions, most in [(1, 3), (8, 200), (13, 4000), (64, 256), (7, 0)]:
        a, b = (rng.integers(-most, most + 1, (n, dimensions)) for n in (9, 50))
        planes = hn.bit_planes(b)
        assert (hn.from_planes(planes, dimensions) == b).all()
        for kind in (np.int32, np.int64):
            assert (hn.scores(hn.subset_sums(a, kind), planes) == b @ a.T).all()


def test_least_values_need_no_further_plane():
    values = np.array([[-4, 3, -1, 0]])
    assert hn.bit_planes(values).shape[1] == 3 and (hn.from_planes(hn.bit_planes(values), 4) == values).all()


def test_too_large_components_are_refused():
    with pytest.raises(ValueError, match="63 bits"):
        hn.quantised(np.array([1e300]))


def test_lists_keep_the_first():
    rng = random.Random(2)
    best, held = hn._Best(3, 4), {0: [], 1: [], 2: []}
    for _ in range(200):
        n = rng.randrange(1, 6)
        keys, score, ids = ([rng.randrange(k) for _ in range(n)] for k in (3, 5, 50))
        for k, s, i in zip(keys, score, ids):
            held[k].append((-s, i))
        best.add(np.array(keys), np.array(score), np.array(ids))
    for k, rows in held.items():
        assert [(-s, i) for s, i in zip(best.scores[k].tolist(), best.ids[k].tolist())] == sorted(rows)[:4]
