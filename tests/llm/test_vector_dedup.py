import math

import numpy as np
import pytest

from gondola.llm import vector_dedup

COLUMNS = "vec_id long, embedding array<float>, label int, id long, unit string, links int"


def brute(rows, cosine=0.93):
    """All pairs, then the smallest id reachable."""
    x = [np.array(e, np.float32).astype(float) if e and None not in e else np.zeros(1) for _, e, _ in rows]
    good = [bool(np.isfinite(v).all() and v.any()) and r[2] is not None for v, r in zip(x, rows)]
    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                a, b = x[i] / np.abs(x[i]).max(), x[j] / np.abs(x[j]).max()
                linked[i, j] = linked[j, i] = a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine
    result = []
    for i in range(n):
        reached, queue = {i}, [i]
        while queue:
            for j in np.flatnonzero(linked[queue.pop()]).tolist():
                if j not in reached:
                    reached.add(j)
                    queue.append(j)
        lowest = min((rows[j][0] for j in reached if rows[j][0] is not None), default=None)
        result.append((rows[i][0], int(linked[i].sum()), lowest, rows[i][0] == lowest))
    return sorted(result, key=str)


def got(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "u", 2) for r in rows], COLUMNS).repartition(3)
    return sorted((tuple(r) for r in vector_dedup.near_duplicates(frame, **options).collect()), key=str)


def planted(seed, spread, number, dims=16):
    """Groups of near copies, chains of links, a dense place, single vectors."""
    rnd = np.random.default_rng(seed)
    rows = []
    for size in number:
        base = rnd.normal(size=dims)
        base /= np.linalg.norm(base)
        noise = rnd.normal(size=(size, dims)) * spread / math.sqrt(dims)
        rows += (base + noise * rnd.random((size, 1)) * 2).tolist()
    steps = np.cumsum(rnd.normal(size=(12, dims)) * 0.06, 0) + rnd.normal(size=dims)
    return rows + steps.tolist()


@pytest.mark.parametrize("tile, spread", [(vector_dedup.TILE, 0.2), (16, 0.25), (7, 0.1)])
def test_equals_all_pairs(spark, tile, spread):
    vectors = planted(tile, spread, [40, 25, 9, 5, 3, 2, *[1] * 40])
    labels = np.random.default_rng(1).integers(0, 2, len(vectors)).tolist()
    labels[:60] = [0] * 60
    rows = [(i, v, k) for i, (v, k) in enumerate(zip(vectors, labels))]
    rows += [(500 + i, vectors[3], 0) for i in range(6)] + [(3, vectors[80], 1), (None, vectors[2], 0), (None, [9.0] * 16, 1)]
    assert got(spark, rows, tile=tile) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [1.0, 1.0], None), (8, [1.0, 1.0], 1), (9, [3e38, 3e38], 1), (10, [1e-44, 1e-44], 1), (11, [1.0, 1.0, 0.0], 1),
            (12, [-1.0, -1.0], 1), (13, [0.0, -0.0], 1), (14, [1.0, 1.0], 2), (8, [1.0, 1.0], 1), (15, [-0.0, 2.0], 1), (16, [0.0, 2.0], 1)]
    assert got(spark, rows) == brute(rows)


def test_no_vectors(spark):
    assert got(spark, []) == [] and got(spark, [(None, None, None), (4, None, 1)]) == [(4, 0, 4, True), (None, 0, None, True)]


def test_a_dense_place_is_a_ball_and_not_compared():
    vectors = np.array(planted(5, 0.1, [200, 1, 1, 1], 32))
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    space = vector_dedup.space(units, 0.93, len(units))
    own, _ = vector_dedup._ball_of(units, space)
    assert len(space.balls) >= 1 and (own[:200] > 0).mean() > 0.9
    inside = units[own == 1]
    assert (inside @ inside.T).min() >= 0.93


def test_a_near_pair_is_within_the_share_of_some_block():
    rnd = np.random.default_rng(2)
    units = rnd.normal(size=(400, 64)) * np.linspace(3, 0.3, 64)
    units = np.concatenate([units, units + rnd.normal(size=units.shape) * 0.3])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    space = vector_dedup.space(units, 0.93, 100000)
    assert len(space.blocks) == 4 and len(space.boxes[0][0]) > 8 and sum(s.stop - s.start for s in space.blocks) == 64
    points = units @ space.rotation
    near = np.argwhere(units @ units.T >= 0.93)
    difference = (points[near[:, 0]] - points[near[:, 1]]) ** 2
    within = [difference[:, s].sum(1) <= share for s, share in zip(space.blocks, space.shares)]
    assert len(near) > 900 and np.any(within, 0).all()


def test_boxes_fill_the_space_once():
    rnd = np.random.default_rng(3)
    low, high = vector_dedup._boxes(rnd.normal(size=(300, 3)), 20)
    points = rnd.normal(size=(1000, 1, 3)) * 3
    assert (((low <= points) & (points < high)).all(2).sum(1) == 1).all()
