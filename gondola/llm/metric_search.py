"""Exact top-k search by inner product on a distributed M-tree.

The largest inner product is the smallest distance once every vector gets one more component
that brings all to one length, and the query gets zero there. Vectors are dealt to routing
objects, the nearest of those picked from a bounded sample; each keeps its covering radius. A
routing object's vectors lie in slices of bounded size, and each slice is a node of pages: a
page has a centre, a covering radius, the centre's distance to the node's own centre, and the
vectors sorted by their distance to the page's centre.

A query visits pages by their least possible distance, best first, until that exceeds the
distance of its k-th best. A page is not measured where the stored distance of its centre to
the node's rules it out by the triangle inequality, nor a vector where its distance to the
page's centre does. Queries first ask one slice of their nearest routing object; the k-th best
there bounds which other routing objects, and what in them, they need.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gondola.session import written

SCALE, K, EVERY = 64, 20, 20
#: Rows, in the order of a hash, that routing objects are picked from, and how many are.
SAMPLE, ROUTES = 2048, 16
SLICE_ROWS, PAGE_ROWS = 4096, 64
#: Queries that meet a slice at once.
QUERY_BLOCK = 8192
#: Distances are floating point; what is this near to a bound is not ruled out.
SLACK = 1e-6
EXACT = float(1 << 52)


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as a long; NULL where the vector or a component is NULL or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    good = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.when(good, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def _rows(column, width: int) -> np.ndarray:
    """Whole-number vectors as a matrix, shorter ones filled up with zeros."""
    result = np.zeros((len(column), width), np.int64)
    for row, vector in zip(result, column):
        row[: len(vector)] = vector
    return result


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component, so that all rows have the length ``longest``."""
    x = x.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(longest ** 2 - (x * x).sum(1), 0))[:, None]])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def _far_apart(points: np.ndarray, number: int) -> np.ndarray:
    """Places of rows far from each other, the first one far from the mean."""
    chosen = [int(np.argmax(((points - points.mean(0)) ** 2).sum(1)))]
    least = ((points - points[chosen[0]]) ** 2).sum(1)
    while len(chosen) < number and least.max() > 0:
        chosen.append(int(np.argmax(least)))
        least = np.minimum(least, ((points - points[chosen[-1]]) ** 2).sum(1))
    return np.array(chosen)


def _products(a: np.ndarray, b: np.ndarray, longest: float) -> np.ndarray:
    """Exact inner products; floating point only where every sum is below 2^52."""
    if longest ** 2 < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Node:
    """The pages of one slice."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, longest: float, page_rows: int = PAGE_ROWS):
        points = _lifted(x, longest)
        centres = points[_far_apart(points, -(-len(x) // page_rows))]
        near = np.argmin(_distances(points, centres), 1)
        self.longest, self.pages, centre_of = longest, [], []
        for j, centre in enumerate(centres):
            members = np.flatnonzero(near == j)
            distance = np.sqrt(((points[members] - centre) ** 2).sum(1))
            order = np.argsort(distance, kind="stable")
            for start in range(0, len(members), page_rows):
                at = order[start: start + page_rows]
                self.pages.append((ids[members[at]], x[members[at]], distance[at]))
                centre_of.append(centre)
        self.centres = np.array(centre_of)
        self.radii = np.array([p[2][-1] for p in self.pages])
        self.middle = points.mean(0)
        self.to_middle = np.sqrt(((self.centres - self.middle) ** 2).sum(1))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, bound: np.ndarray, k: int):
        """(query place, vec_id, score) of at most k best per query, none that ``bound``, a score, rules out."""
        number = len(queries)
        points = np.hstack([queries.astype(np.float64), np.zeros((number, 1))])
        lengths = (points * points).sum(1)
        reach = lambda score: np.sqrt(np.maximum(lengths + self.longest ** 2 - 2 * score, 0)) + SLACK
        bound = bound.astype(np.float64)
        worst = reach(bound)
        from_middle = np.sqrt(((points - self.middle) ** 2).sum(1))
        rough = np.abs(from_middle[:, None] - self.to_middle) - self.radii
        centre = np.full(rough.shape, np.inf)
        for j in range(len(self.pages)):
            asked = np.flatnonzero(rough[:, j] <= worst)
            centre[asked, j] = np.sqrt(((points[asked] - self.centres[j]) ** 2).sum(1))
        least = centre - self.radii
        order = np.argsort(least, 1, kind="stable")
        top = np.full((number, k), -np.inf)
        found = []
        for step in range(order.shape[1]):
            page = order[:, step]
            live = least[np.arange(number), page] <= worst
            if not live.any():
                break
            fresh = np.full((number, PAGE_ROWS), -np.inf)
            for j in np.unique(page[live]):
                asked = np.flatnonzero(live & (page == j))
                ids, x, own = self.pages[j]
                # Vectors nearer to the page's centre than this are too far from every query here.
                low = np.searchsorted(own, (centre[asked, j] - worst[asked]).min(), "left")
                scores = _products(queries[asked], x[low:], self.longest)
                good = (scores >= bound[asked, None]) & (ids[None, low:] != query_ids[asked, None])
                if good.any():
                    r, c = np.nonzero(good)
                    found.append((asked[r], ids[low:][c], scores[r, c]))
                    fresh[asked[:, None], np.arange(scores.shape[1])] = np.where(good, scores, -np.inf)
            top = np.partition(np.hstack([top, fresh]), -k, axis=1)[:, -k:]
            bound = np.maximum(bound, top.min(1))
            worst = reach(bound)
        if not found:
            return np.array([], np.int64), np.array([], np.int64), np.array([], np.int64)
        place, ids, scores = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((ids, -scores, place))
        place, ids, scores = place[order], ids[order], scores[order]
        first = np.searchsorted(place, place, "left")
        best = np.arange(len(place)) - first < k
        return place[best], ids[best], scores[best]


class Plan:
    """What every task needs: routing objects with their radii and slices, and the longest length."""

    def __init__(self, x: np.ndarray, longest: float, routes: int, rows: int, query_blocks: int):
        points = _lifted(x, longest)
        self.width, self.longest, self.query_blocks = x.shape[1], longest, query_blocks
        self.routes = points[_far_apart(points, routes)]
        self.slices = np.ones(len(self.routes), np.int64)
        self.radii = np.zeros(len(self.routes))


def _dealt(plan: Plan):
    """vec_id, v -> route and distance to it."""

    def deal(batches):
        for rows in batches:
            d = _distances(_lifted(_rows(rows["v"], plan.width), plan.longest), plan.routes)
            yield rows.assign(route=np.argmin(d, 1), distance=d.min(1))

    return deal


def _asked(plan: Plan, k: int, first: bool):
    """Queries -> the slices they ask: one of the nearest route at first, then all that their bound allows."""

    def ask(batches):
        for rows in batches:
            q = _rows(rows["v"], plan.width).astype(np.float64)
            points = np.hstack([q, np.zeros((len(q), 1))])
            d = _distances(points, plan.routes)
            reach = np.sqrt(np.maximum((q * q).sum(1) + plan.longest ** 2 - 2 * rows["bound"].to_numpy(np.float64), 0)) + SLACK
            for route in range(len(plan.routes)):
                wanted = np.argmin(d, 1) == route if first else d[:, route] - plan.radii[route] <= reach
                for part in range(1 if first else plan.slices[route]):
                    if wanted.any():
                        yield rows[wanted].assign(route=route, slice=part)

    return ask


def _met(plan: Plan, k: int):
    def meet(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(vectors) or not len(queries):
            return pd.DataFrame({n: np.array([], np.int64) for n in names})
        node = Node(vectors["vec_id"].to_numpy(), _rows(vectors["v"], plan.width), plan.longest)
        ids = queries["vec_id"].to_numpy()
        place, found, scores = node.search(ids, _rows(queries["v"], plan.width), queries["bound"].to_numpy(np.float64), k)
        return pd.DataFrame({"query_id": ids[place], "vec_id": found, "score": scores})

    return meet


def top_k(vectors: DataFrame, queries: Column, k: int = K, slice_rows: int = SLICE_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (vec_id, v array<long>) that the
    condition ``queries`` holds for, its ``k`` rows of highest inner product but itself, ties to the
    smaller vec_id, all if there are fewer.

    Rows with a NULL in vec_id or v take no part; of several vectors under one vec_id the
    smallest does. Vectors of different lengths are filled up with zeros.
    """
    usable = vectors.filter("vec_id is not null and v is not null and size(v) > 0")
    rows = written(usable.select("vec_id", "v", F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x).alias("square"))
                   .groupBy("vec_id").agg(F.min_by(F.struct("v", "square"), "v").alias("r")).select("vec_id", "r.v", "r.square"))
    asks = F.coalesce(queries, F.lit(False))
    total = rows.agg(F.max("square"), F.max(F.size("v")), F.count("*"), F.count(F.when(asks, 1))).first()
    if not total[2] or not total[3]:
        return rows.limit(0).select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    plan = Plan(_rows([r.v for r in sample], total[1]), math.sqrt(total[0]), ROUTES, total[2], -(-total[3] // query_block))
    routed = written(rows.select("vec_id", "v").mapInPandas(_dealt(plan), "vec_id long, v array<bigint>, route int, distance double"))
    for r in routed.groupBy("route").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect():
        plan.slices[r.route], plan.radii[r.route] = -(-r.n // slice_rows), r.radius + SLACK
    counts = F.array(*[F.lit(int(n)) for n in plan.slices])
    spread = F.pmod(F.xxhash64("vec_id"), F.element_at(counts, F.col("route") + 1)).cast("int")
    blocks = F.explode(F.sequence(F.lit(0), F.lit(plan.query_blocks - 1))).alias("block")
    held = routed.select("vec_id", "v", "route", spread.alias("slice"), blocks)
    asked = rows.filter(asks).select(
        "vec_id", "v", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(plan.query_blocks)).cast("int").alias("block"))
    key = ["route", "slice", "block"]
    schema = "vec_id long, v array<bigint>, block int, bound double, route int, slice int"

    def ask(queries: DataFrame, first: bool) -> DataFrame:
        there = queries.mapInPandas(_asked(plan, k, first), schema)
        return held.groupBy(*key).cogroup(there.groupBy(*key)).applyInPandas(_met(plan, k), "query_id long, vec_id long, score long")

    start = ask(asked.withColumn("bound", F.lit(-math.inf)), True)
    bounds = start.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    bounds = written(bounds.filter(F.col("n") >= k).select("query_id", F.col("least").cast("double").alias("least")))
    bounded = asked.join(bounds, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", "v", "block", F.coalesce("least", F.lit(-math.inf)).alias("bound"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = ask(bounded, False).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def report(embeddings: DataFrame) -> DataFrame:
    """``top_k`` of the rows (vec_id, embedding) whose vec_id is divisible by 20, on floor(64 x)."""
    rows = embeddings.select("vec_id", whole_numbers(F.col("embedding")).alias("v"))
    return top_k(rows, F.col("vec_id") % EVERY == 0)
