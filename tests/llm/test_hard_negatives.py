import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from commwatch.llm.hard_negatives import _augmented, cover_tree, mine_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, anchor boolean, row string, query int"


def usable(row):
    key, vector, label = row[:3]
    return (
        key is not None
        and label is not None
        and bool(vector)
        and all(x is not None and math.isfinite(x) for x in vector)
        and sum((256 * float(x)) ** 2 for x in vector) < 2**61
    )


def plain(rows, positives=5, negatives=10):
    rows = [r for r in rows if usable(r)]
    dims = max((len(r[1]) for r in rows), default=0)
    points = [[math.floor(256 * float(np.float32(x))) for x in r[1]] + [0] * (dims - len(r[1])) for r in rows]
    out = []
    for a, row in enumerate(rows):
        if not row[3]:
            continue
        score = [sum(x * y for x, y in zip(points[a], p)) for p in points]
        order = sorted(range(len(rows)), key=lambda i: (-score[i], rows[i][0], i))
        for p in [i for i in order if rows[i][2] == row[2] and i != a][:positives]:
            fits = [
                i for i in order
                if rows[i][2] != row[2] and 30 * score[p] <= 100 * score[i] <= 90 * score[p]
            ][:negatives]
            out += [(row[0], rows[p][0], k + 1, rows[i][0], score[p], score[i]) for k, i in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, parts=3, **options):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    result = mine_hard_negatives(frame, **options)
    assert result.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    return sorted(map(tuple, result.collect()))


def vectors(seed, n, dims=8, kinds=4, spread=0.4):
    """Clusters whose labels agree with them for the most part."""
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(kinds, dims))
    kind = draw.integers(0, kinds, n)
    points = middle[kind] + spread * draw.normal(size=(n, dims))
    label = np.where(draw.random(n) < 0.7, kind, draw.integers(0, kinds, n))
    return [
        (i, [float(np.float32(x)) for x in p], int(l), i % 9 == 0)
        for i, (p, l) in enumerate(zip(points, label))
    ]


@pytest.mark.parametrize("wave, block_rows", [(4096, 2048), (20, 90)])
def test_negatives_by_brute_force(spark, wave, block_rows):
    rows = vectors(3, 600)
    assert mined(spark, rows, wave=wave, block_rows=block_rows) == plain(rows)


def test_odd_rows(spark):
    rows = vectors(5, 80, kinds=2)
    inf, nan = float("inf"), float("nan")
    rows += [
        (None, [1.0] * 8, 0, True), (501, None, 0, True), (502, [1.0] * 8, None, True),
        (503, [nan] * 8, 1, False), (504, [inf] + [0.0] * 7, 1, False), (505, [1.0, None], 1, False),
        (506, [], 1, True), (507, [0.5, -0.25], 1, True), (508, [3e30] * 8, 1, True),
        (509, [0.0] * 8, 1, True), (510, [1.0] * 8, 77, True), (511, [-2.5] * 8, 0, None),
    ]
    assert mined(spark, rows, block_rows=16) == plain(rows)


def test_ties_and_very_common_vectors(spark):
    """Most vectors are equal, so that results are chosen by their keys."""
    draw = random.Random(2)
    rows = [(i, [0.5, 0.25, -0.5], i % 3, i % 50 == 0) for i in range(400)]
    rows += [(i, [0.25 * draw.randrange(3) for _ in range(3)], i % 3, i % 50 == 0) for i in range(400, 600)]
    assert mined(spark, rows, block_rows=64) == plain(rows)


def test_repeated_rows_are_rows(spark):
    rows = vectors(8, 60, kinds=2)
    rows += rows[:20]
    assert mined(spark, rows) == plain(rows)


def test_large_numbers_are_exact(spark):
    rows = [
        (i, [c * s for c in v], label, anchor)
        for (i, v, label, anchor), s in zip(vectors(9, 120, dims=3), [2.0**19] * 120)
    ]
    assert mined(spark, rows, block_rows=32) == plain(rows)


def test_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0, False), (3, [1.0], 1, False)]) == []
    assert mined(spark, [(1, [1.0], 0, True)]) == []


@pytest.mark.parametrize("points", [
    np.random.default_rng(1).normal(size=(700, 6)),
    np.repeat(np.random.default_rng(2).normal(size=(5, 6)), 100, axis=0),
    np.random.default_rng(3).normal(size=(300, 6)) * np.geomspace(1e-3, 1e3, 300)[:, None],
    np.zeros((1, 6)),
])
def test_tree_covers_its_points(points):
    """Each point lies in one leaf, within the radii of all nodes above it; radii shrink."""
    own = _augmented(points, (points * points).sum(1).max())
    order, nodes, reach, first, last = cover_tree(own)
    assert sorted(order.tolist()) == list(range(len(points)))
    seen = np.zeros(len(points), int)
    for leaf in range(len(nodes)):
        for at in range(first[leaf], last[leaf]):
            seen[at] += 1
            node = leaf
            while node >= 0:
                d = np.linalg.norm(own[order[at]] - own[nodes[node, 2]])
                # the radius itself comes from a product, which rounds more coarsely
                scale = 1e-6 * (1 + np.linalg.norm(own[order[at]]))
                assert reach[node, 0] - scale <= d <= reach[node, 1] + scale
                node = nodes[node, 0]
    assert (seen == 1).all()
    assert (last - first <= 64).all() or len(np.unique(points, axis=0)) < len(points)


def test_query_by_brute_force(spark, sf_dir):
    from commwatch.llm.queries import op13_hard_negatives

    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    rows = table.select("vec_id", "embedding", label, F.expr("vec_id % 500 = 0")).collect()
    got = [r for r in map(tuple, op13_hard_negatives(spark, sf_dir).collect()) if r[0] % 500 == 0]
    assert sorted(got) == plain(rows)
