"""Near-duplicate vectors of one label: links by cosine, through a pigeonhole join of subspaces.

Unit vectors with a cosine of at least c are at most sqrt(2 - 2c) apart. They are rotated to the
axes of largest variance and split into blocks of coordinates. Each block gets a share of the
squared distance in proportion to its variance; a pair that is near in all coordinates is
within the share in some block. So each block is range-joined under its share: its space is
cut into boxes, a vector is *home* in its own box and visits every box within range, and home
vectors are compared with visitors. A pair counts in the first block that has it within the
share, and only after its cosine over all coordinates was checked.

Equal vectors are one class and never compared. A very dense place, where a part of all
vectors lies within half the range of one of them, is found in a sample and becomes a *ball*:
its members are all linked, by the triangle inequality, and are counted instead of compared.
Others meet them only if they are within range of the ball.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gondola.llm.common import components
from gondola.session import written

COSINE = 0.93
BLOCKS = 4
#: Home vectors that are compared at once; more in one box are dealt to several tasks.
TILE = 8192
#: Vectors, in the order of a hash, that the axes and boxes are taken from, and the most boxes of a block.
SAMPLE, BOXES = 16384, 2048
#: Vectors of the sample among which balls are looked for, the fewest in a ball, the most balls.
DENSE_SAMPLE, DENSE, BALLS = 2048, 8, 64
#: What floating point may add to a distance.
SLACK = 1e-9
PLACE_ROWS, VISITORS, PAIRS = 1024, 512, 1 << 15
#: Stand for an id that is NULL in union-find; behind every id.
NO_ID = (1 << 63) - 1


def _matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, embedding) to (vec_id, label, digest, unit): NULL where the row takes no part."""
    for batch in batches:
        labels, digests, units = batch.column(1).to_pylist(), [], []
        for label, vector in zip(labels, batch.column(2).to_pylist()):
            good = label is not None and vector and None not in vector
            x = np.array(vector if good else [0.0], np.float64) + 0.0
            largest = np.abs(x).max()
            if not good or not np.isfinite(x).all() or not largest:
                digests.append(None)
                units.append(None)
                continue
            digests.append(hashlib.sha256(repr(label).encode() + b" " + x.tobytes()).digest())
            x = x / largest  # no square over- or underflows
            units.append((x / np.sqrt((x * x).sum())).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
            names=["vec_id", "label", "digest", "unit"],
        )


class Space(NamedTuple):
    """Axes, blocks of coordinates with their shares, boxes of each block, balls."""

    rotation: np.ndarray
    blocks: list[slice]
    shares: list[float]
    boxes: list[tuple[np.ndarray, np.ndarray]]
    balls: np.ndarray
    cosine: float

    @property
    def reach(self) -> float:
        return float(np.sqrt(2 - 2 * self.cosine))

    @property
    def radius(self) -> float:
        """Of a ball: two members are less than ``reach`` apart."""
        return self.reach / 2 * (1 - 1e-6)


def _boxes(points: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper corners of ``number`` boxes that fill the space, halved at medians."""
    width = points.shape[1]
    parts = [(points, np.full(width, -np.inf), np.full(width, np.inf))]
    while len(parts) < number:
        parts.sort(key=lambda p: -len(p[0]))
        inside, low, high = parts[0]
        axis = int(np.argmax(inside.var(0)))
        middle = np.median(inside[:, axis])
        left = inside[:, axis] < middle
        if not left.any():
            break
        under, over = high.copy(), low.copy()
        under[axis] = over[axis] = middle
        parts[0:1] = [(inside[left], low, under), (inside[~left], over, high)]
    return np.array([p[1] for p in parts]), np.array([p[2] for p in parts])


def _dense(units: np.ndarray, radius: float, fewest: int) -> np.ndarray:
    """Vectors with at least ``fewest`` others, not yet in a ball, within ``radius``; the fullest first."""
    near = units @ units.T >= 1 - radius * radius / 2
    left, found = np.ones(len(units), bool), []
    while len(found) < BALLS and len(units):
        counts = (near & left).sum(1)
        best = int(np.argmax(counts))
        if counts[best] < fewest:
            break
        found.append(units[best])
        left &= ~near[best]
    return np.array(found).reshape(len(found), units.shape[1])


def space(sample: np.ndarray, cosine: float, most: int, tile: int = TILE, blocks: int = BLOCKS) -> Space:
    """The space for unit vectors of which ``sample`` are some and of which one label has ``most``."""
    values, vectors = np.linalg.eigh(sample.T @ sample / len(sample))
    values, rotation = np.maximum(values[::-1], 1e-12), np.ascontiguousarray(vectors[:, ::-1])
    shares = np.cumsum(values) / values.sum()
    cuts = np.unique([0, *(int(np.searchsorted(shares, i / blocks)) + 1 for i in range(1, blocks)), len(values)])
    slices = [slice(int(a), int(b)) for a, b in zip(cuts, cuts[1:])]
    reach2 = 2 - 2 * cosine
    points = sample @ rotation
    number = min(BOXES, -(-most // tile), max(1, len(sample) // 8))
    result = Space(
        rotation, slices, [reach2 * float(values[s].sum() / values.sum()) + SLACK for s in slices],
        [_boxes(points[:, s], number) for s in slices], np.zeros((0, len(values))), cosine,
    )
    return result._replace(balls=_dense(sample[:DENSE_SAMPLE], result.radius, DENSE))


PLACED = (
    "label {label}, size int, block int, box int, ball int, home boolean, id bigint, mark bigint, copies bigint, point binary"
)
KEY = ["label", "size", "block", "box", "ball"]


def _units(raw: list[bytes], width: int) -> np.ndarray:
    """Vectors as a matrix, shorter ones filled up with zeros."""
    result = np.zeros((len(raw), width))
    for row, x in zip(result, raw):
        row[: len(x) // 8] = np.frombuffer(x)
    return result


def _ball_of(units: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """(the ball of each, 0 for none; by ball, 0 first, which are in range of it)."""
    none = np.zeros((len(units), 1), bool)
    if not len(space.balls):
        return np.zeros(len(units), np.int64), none
    cosines = units @ space.balls.T
    best = np.argmax(cosines, 1)
    inside = cosines[np.arange(len(units)), best] >= 1 - space.radius ** 2 / 2
    far = space.reach + space.radius + 1e-6
    return np.where(inside, best + 1, 0), np.hstack([none, cosines >= 1 - far * far / 2])


def _members(space: Space):
    """The ball of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("unit").to_pylist()
            own, _ = _ball_of(_units(raw, len(space.rotation)), space)
            size = pa.array([len(u) // 8 for u in raw], pa.int32())
            columns = [batch.column(c) for c in ("id", "mark", "copies", "label")]
            names = ["id", "mark", "copies", "label", "size", "ball"]
            yield pa.RecordBatch.from_arrays([*columns, size, pa.array(own, pa.int32())], names=names)

    return run


def _place(space: Space):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(i, PLACE_ROWS) for b in batches for i in range(0, b.num_rows, PLACE_ROWS))
        for batch in parts:
            size = np.array([len(u) // 8 for u in batch.column("unit").to_pylist()])
            units = _units(batch.column("unit").to_pylist(), len(space.rotation))
            points = units @ space.rotation
            own, near = _ball_of(units, space)
            out = [[], [], [], [], []]
            for b, part in enumerate(space.blocks):
                low, high = space.boxes[b]
                x = points[:, part]
                apart = np.zeros((len(x), len(low)))
                inside = np.ones(apart.shape, bool)
                for j in range(x.shape[1]):
                    c = x[:, j:j + 1]
                    apart += np.maximum(np.maximum(low[:, j] - c, c - high[:, j]), 0) ** 2
                    inside &= (low[:, j] <= c) & (c < high[:, j])
                home = np.argmax(inside, 1)
                visited = apart <= space.shares[b] + SLACK
                for ball in range(near.shape[1]):
                    # To the loose vectors' boxes everything goes, to a ball's those in range that are not its own.
                    goes = visited & (near[:, ball, None] if ball else True) & ~((own == ball) & (own > 0))[:, None]
                    if not ball:
                        goes[np.flatnonzero(own == 0), home[own == 0]] = False
                    row, box = np.nonzero(goes)
                    for column, values in zip(out, (row, np.full(len(row), b), box, np.full(len(row), ball), np.zeros(len(row), bool))):
                        column.append(values)
                every = np.arange(len(x))
                for column, values in zip(out, (every, np.full(len(x), b), home, own, np.ones(len(x), bool))):
                    column.append(values)
            row, block, box, ball, is_home = map(np.concatenate, out)
            raw = [points[i].tobytes() for i in range(len(points))]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").take(at), pa.array(size[row], pa.int32()), pa.array(block, pa.int32()),
                 pa.array(box, pa.int32()), pa.array(ball, pa.int32()), pa.array(is_home), batch.column("id").take(at),
                 batch.column("mark").take(at), batch.column("copies").take(at), pa.array(raw, pa.binary()).take(at)],
                names=[*KEY, "home", "id", "mark", "copies", "point"],
            )

    return run


FOUND = "id bigint, mark bigint, other_id bigint, other_mark bigint, links bigint"


class _Rows(NamedTuple):
    ids: np.ndarray
    marks: np.ndarray
    copies: np.ndarray
    points: np.ndarray

    def part(self, at) -> _Rows:
        return _Rows(*(x[at] for x in self))


def _compare(space: Space):
    """Rows sorted by box and home first, to links of each home vector and edges that connect the linked."""

    def near(x: np.ndarray, y: np.ndarray, block: int) -> np.ndarray:
        difference = x[:, space.blocks[block]] - y[:, space.blocks[block]]
        return (difference * difference).sum(1) <= space.shares[block]

    def linked(homes: _Rows, others: _Rows, block: int, same_from: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the linked pairs that this block counts."""
        x, y = (np.ascontiguousarray(r.points[:, space.blocks[block]]) for r in (homes, others))
        rough = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T <= space.shares[block] + SLACK
        if same_from is not None:
            rough[np.arange(same_from, same_from + len(y)), np.arange(len(y))] = False
        found = []
        every_i, every_j = np.nonzero(rough)
        for start in range(0, len(every_i), PAIRS):
            i, j = every_i[start:start + PAIRS], every_j[start:start + PAIRS]
            keep = near(homes.points[i], others.points[j], block)
            for earlier in range(block):
                i, j = i[keep], j[keep]
                keep = ~near(homes.points[i], others.points[j], earlier)
            i, j = i[keep], j[keep]
            keep = (homes.points[i] * others.points[j]).sum(1) >= space.cosine
            found.append((i[keep], j[keep]))
        if not found:
            return every_i, every_j
        return tuple(map(np.concatenate, zip(*found)))

    def group(block: int, ball: int, homes: _Rows, visitors: Iterator[_Rows]) -> Iterator[pa.RecordBatch]:
        degree = np.zeros(len(homes.ids), np.int64)
        # The home vectors of a ball are linked as they are.
        starts = [] if ball else range(0, len(homes.ids), VISITORS)
        own = ((homes.part(slice(s, s + VISITORS)), s) for s in starts)
        for chunk, same in chain(own, ((c, None) for c in visitors)):
            i, j = linked(homes, chunk, block, same)
            if not len(i):
                continue
            np.add.at(degree, i, chunk.copies[j])
            # The first home vector linked to a visitor stands for it: visitor and others are tied to that one.
            first = np.full(len(chunk.ids), len(homes.ids))
            np.minimum.at(first, j, i)
            a, b = np.unique(np.stack([i, first[j]]), axis=1)
            some = np.flatnonzero(first < len(homes.ids))
            yield edges(homes.part(a), homes.part(b))
            yield edges(homes.part(first[some]), chunk.part(some))
        some = np.flatnonzero(degree)
        none = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(homes.ids[some]), pa.array(homes.marks[some]), none, none, pa.array(degree[some])], names=names
        )

    names = [f.split(" ")[0] for f in FOUND.split(", ")]

    def edges(a: _Rows, b: _Rows) -> pa.RecordBatch:
        differ = (a.ids != b.ids) | (a.marks != b.marks)
        a, b = a.part(differ), b.part(differ)
        columns = [a.ids, a.marks, b.ids, b.marks]
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.nulls(len(a.ids), pa.int64())], names=names)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, _Rows]]:
        """(key, home, rows) of rows next to each other, not over batches."""
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in [*KEY, "bucket", "home"])))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            numbers = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "mark", "copies")]
            points = _matrix(batch.column("point").to_pylist()) if keys else None
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    yield keys[a][:-1], keys[a][-1], _Rows(*(n[a:b] for n in numbers), points[a:b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ahead = stretches(batches), None
        ahead = next(rows, None)
        while ahead:
            key, homes = ahead[0], []
            while ahead and ahead[0] == key and ahead[1]:
                homes.append(ahead[2])
                ahead = next(rows, None)

            def visitors() -> Iterator[_Rows]:
                nonlocal ahead
                while ahead and ahead[0] == key:
                    for s in range(0, len(ahead[2].ids), VISITORS):
                        if homes:
                            yield ahead[2].part(slice(s, s + VISITORS))
                    ahead = next(rows, None)

            if homes:
                yield from group(key[2], key[4], _Rows(*map(np.concatenate, zip(*homes))), visitors())
            for _ in visitors():
                pass

    return run


def links(classes: DataFrame, space: Space, tile: int = TILE) -> DataFrame:
    """Links among classes (id, mark, label, unit, copies) that share no ball.

    Rows with ``links``: how many vectors a class is linked to; they add up. Rows with
    ``other_id``: pairs that connect what is linked, some but not all of the linked pairs.
    """
    kind = classes.schema["label"].dataType.simpleString()
    placed = classes.mapInArrow(_place(space), PLACED.format(label=kind))
    full = placed.filter("home").groupBy(KEY).count().filter(F.col("count") > tile)
    full = written(full.select(*KEY, F.ceil(F.col("count") / tile).cast("int").alias("parts")))
    dealt = placed.withColumn("bucket", F.lit(0))
    if not full.isEmpty():
        own = F.pmod(F.xxhash64("id", "mark"), F.col("parts")).cast("int")
        # A vector of a ball stays out of its ball's other buckets.
        alone = F.col("home") & (F.col("ball") > 0)
        buckets = F.when(alone, F.array("own")).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
        dealt = placed.join(full, KEY, "left").fillna(1, ["parts"]).withColumn("own", own)
        dealt = dealt.withColumn("bucket", F.explode(buckets))
        dealt = dealt.withColumn("home", F.col("home") & (F.col("bucket") == F.col("own"))).select(*placed.columns, "bucket")
    order = [*KEY, "bucket"]
    return dealt.repartition(*order).sortWithinPartitions(*order, F.desc("home")).mapInArrow(_compare(space), FOUND)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, tile: int = TILE) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Linked are vectors of one label and length whose cosine, in double precision, is at least
    ``cosine``; ``n_links`` counts the other rows a row is linked to, equal vectors included.
    ``component_id`` is the smallest vec_id reachable over links, the own included, and
    ``kept`` whether that is the own. A vector that is NULL, empty or zero, holds NULL or what
    is not finite, or has no label links with nothing. Rows that repeat a vec_id are vectors of
    their own; a NULL vec_id is smaller than none, NULL where no other is reachable, and then
    ``kept``. Other columns are ignored; no rows give no rows.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must be over 0 and at most 1")
    kind = vectors.schema["label"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    rows = written(rows.mapInArrow(_prepare, f"vec_id bigint, label {kind}, digest binary, unit binary"))
    classes = rows.filter("digest is not null").groupBy("digest").agg(
        F.first("label").alias("label"), F.first("unit").alias("unit"), F.count("*").alias("copies"),
        F.coalesce(F.min("vec_id"), F.lit(NO_ID)).alias("id"), F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("bigint").alias("mark"),
    )
    classes = written(classes)
    width, = classes.agg(F.max(F.octet_length("unit"))).first()
    alone = rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    if width is None:
        return alone.withColumn("kept", F.lit(True))
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0]
    sample = classes.select("unit", "digest").orderBy("digest").limit(SAMPLE).select("unit").toArrow().column(0).to_pylist()
    where = space(_matrix([u.ljust(width, b"\0") for u in sample]), cosine, most, tile)

    found = written(links(classes, where, tile))
    members = written(classes.mapInArrow(_members(where), f"id bigint, mark bigint, copies bigint, label {kind}, size int, ball int"))
    node = F.struct("id", "mark")
    balls = members.filter("ball > 0").groupBy("label", "size", "ball").agg(
        F.sum("copies").alias("together"), F.min(node).alias("lowest")
    )
    members = members.join(written(balls), ["label", "size", "ball"], "left")
    edges = found.filter("other_id is not null").select(node.alias("a"), F.struct(F.col("other_id").alias("id"), F.col("other_mark").alias("mark")).alias("b"))
    edges = edges.unionByName(members.filter("lowest is not null").select(node.alias("a"), F.col("lowest").alias("b")))
    parts = components(edges).select("node.id", "node.mark", F.col("component.id").alias("component_id"))
    counted = found.filter("other_id is null").groupBy("id", "mark").agg(F.sum("links").alias("links"))
    result = members.join(counted, ["id", "mark"], "left").join(parts, ["id", "mark"], "left")
    result = written(result.select(
        F.col("id").alias("class_id"), F.col("mark").alias("class_mark"),
        (F.coalesce("together", "copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    ))
    keyed = written(classes.select(F.col("digest").alias("d"), "id", "mark").join(
        result, (F.col("id") == F.col("class_id")) & (F.col("mark") == F.col("class_mark"))
    ).select("d", "n_links", F.nullif("component_id", F.lit(NO_ID)).alias("component_id")))
    joined = rows.filter("digest is not null").join(keyed, F.col("digest") == F.col("d"))
    return joined.select("vec_id", "n_links", "component_id").unionByName(alone.filter("digest is null")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
