import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm import metric_search as m


def brute(rows, k=20, every=20):
    good = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(64 * x) for x in v]
        good[i] = min(good[i], w) if i in good else w
    result = []
    for q in (i for i in good if i % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(good[q], w)), i) for i, w in good.items() if i != q)
        result += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(result)


def clustered(seed, number, width=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, width))
    rows = [(i, (centres[i % 7] * rng.choice([0.2, 1, 3]) + 0.1 * rng.normal(size=width)).tolist()) for i in range(number)]
    return rows + [(number + j, rows[j][1]) for j in range(40)]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("rank", F.lit("x"))
    found = m.top_k(df.select("vec_id", m.whole_numbers(F.col("embedding")).alias("v")), F.col("vec_id") % 20 == 0, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows)
    return df


def test_same_as_all_pairs(spark):
    check(spark, clustered(1, 900))


def test_small_slices_and_query_blocks(spark):
    check(spark, clustered(2, 500), slice_rows=16, query_block=5)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, [0.0, 0.0]), (40, []), (60, None), (80, [1.0, None]), (100, [float("nan"), 1.0]), (120, [float("inf"), 0.0]),
            (None, [1.0, 1.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-1.0, 0.5, 9.0]), (20, [-1.0, 0.0]), (-20, [4.0, 4.0])]
    df = check(spark, rows)
    assert m.report(df.limit(0)).count() == 0
    assert m.report(df.filter("vec_id = 1")).count() == 0


def test_large_whole_numbers_stay_exact(spark):
    rnd = random.Random(3)
    check(spark, [(i, [rnd.choice([-1, 1]) * (3e6 + i) for _ in range(4)]) for i in range(60)])


def test_pages_cover_their_rows_and_are_pruned():
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(2000, 6)) * 5 + rng.integers(0, 2, (2000, 1)) * 200).astype(np.int64)
    longest = float(np.sqrt((x * x).sum(1).max()))
    node = m.Node(np.arange(2000), x, longest)
    points = m._lifted(x, longest)
    for centre, radius, (ids, _, own) in zip(node.centres, node.radii, node.pages):
        distance = np.sqrt(((points[ids] - centre) ** 2).sum(1))
        assert np.allclose(distance, own) and distance.max() <= radius + 1e-9 and len(ids) <= m.PAGE_ROWS
    place, ids, scores = node.search(np.array([-1]), x[:1], np.array([-np.inf]), 5)
    assert scores.tolist() == sorted((x @ x[0]).tolist(), reverse=True)[:5]


@pytest.mark.parametrize("bound", [-math.inf, 0.0])
def test_search_of_nothing(bound):
    node = m.Node(np.array([5]), np.array([[1, 2]]), 3.0)
    assert len(node.search(np.array([5]), np.array([[1, 2]]), np.array([bound]), 3)[0]) == 0
