"""Near-duplicate documents by SimHash, linked through anchor points of a covering code.

A fingerprint has 64 bits. Two that differ in at most 3 bits differ in at most one bit of
their upper or of their lower half. Each half is covered by a code: the perfect Hamming
code on 31 bits times the free 32nd bit, covering radius 1. A fingerprint is *home* at its
own half's anchor, at most 1 away, and is replicated to every anchor within covering radius
plus threshold, 1 + 1 = 2 bits: 17 of the 2^27 anchors at most. A linked pair therefore
meets at the home anchor of either, in the half that differs least, and is compared there.

An anchor at which very many fingerprints are home is split by a second level of anchors on
the other half: its two quarters, one of which differs in at most one bit, with the Hamming
code on 15 bits times the free 16th. What is left in one group is bounded by the code.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm.common import components
from gondola.session import written

THRESHOLD = 3
ANCHORS = "array<struct<anchor:bigint,home:boolean>>"
SHINGLE = 3
SEED = 42
#: Homes at an anchor from which it is split by second-level anchors.
SPLIT_FROM = 4096
CHUNK = 1 << 15


def fingerprint_bits(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text as an unsigned number.

    Words are runs of bytes other than ASCII white space, A-Z in lower case. A bit is set if
    it is set in over half of the shingles' hashes, repeats included. A text of fewer words
    than a shingle has one shingle, its whole word sequence; one without words has print 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), seed)
    total = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    runs = [words[i:] for i in range(1, shingle)]
    pieces = map(b" ".join, zip(words, *runs))
    for start in range(0, total, CHUNK):
        size = min(CHUNK, total - start)
        hashes = np.fromiter((digest(next(pieces), seed) for _ in range(size)), np.uint64, size)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column) -> Column:
    """The 64-bit fingerprint as a signed long; NULL counts as empty and has print 0."""

    @F.arrow_udf("bigint")
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            prints = np.fromiter((fingerprint_bits(t or b"") for t in batch.to_pylist()), np.uint64, len(batch))
            yield pa.array(prints.view(np.int64))

    return apply(text.cast("string").cast("binary"))


def _syndrome(points: np.ndarray, bits: int) -> np.ndarray:
    """XOR of the 1-based numbers of the set bits, for a Hamming code on ``bits`` = 2^k - 1 bits."""
    result = np.zeros(points.shape, np.int64)
    for j in range(int(bits).bit_length()):
        mask = np.uint64(sum(1 << (i - 1) for i in range(1, bits + 1) if i >> j & 1))
        result |= (np.bitwise_count(points & mask).astype(np.int64) & 1) << j
    return result


def _anchor_masks(bits: int) -> np.ndarray:
    """By syndrome: what to flip to reach each anchor within 2 bits, the home anchor first.

    Bit ``bits`` + 1 is the free one. A code word has two such anchors; its row repeats home.
    """
    flip = lambda i: 1 << (i - 1) if i else 0
    rows = []
    for s in range(bits + 1):
        near = [flip(s), flip(s) | 1 << bits]
        near += [flip(a) | flip(a ^ s) for a in range(1, bits + 1) if s and a < a ^ s]
        rows.append(near + [flip(s)] * ((bits + 1) // 2 + 1 - len(near)))
    return np.array(rows, np.uint64)


MASKS = {bits: _anchor_masks(bits) for bits in (31, 15)}


def anchors(points: np.ndarray, bits: int) -> np.ndarray:
    """(n, (bits + 1) / 2 + 1) anchors within 2 bits of each point of ``bits`` + 1 bits; the first is its home."""
    return points[:, None] ^ MASKS[bits][_syndrome(points, bits)]


def _spread(points: np.ndarray, bits: int, part: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor keys marked with ``part``, which of them repeat the home anchor)."""
    near = anchors(points, bits)
    repeated = near[:, 2:] == near[:, :1]
    keys = near.astype(np.int64) | part << (bits + 1)
    return keys, np.concatenate([np.zeros((len(points), 2), bool), repeated], axis=1)


def _lists(keys: np.ndarray, skip: np.ndarray) -> pa.ListArray:
    keep = ~skip
    lengths = keep.sum(1)
    home = np.zeros(keys.shape, bool)
    home[:, 0] = True
    home[:, keys.shape[1] // 2] = True
    items = pa.StructArray.from_arrays([pa.array(keys[keep]), pa.array(home[keep])], names=["anchor", "home"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), items)


def _half_anchors(prints: pa.Array) -> pa.Array:
    values = prints.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    parts = [_spread(values >> np.uint64(32 * h) & np.uint64(0xFFFFFFFF), 31, h) for h in (0, 1)]
    return _lists(np.concatenate([p[0] for p in parts], 1), np.concatenate([p[1] for p in parts], 1))


def _quarter_anchors(prints: pa.Array, first: pa.Array) -> pa.Array:
    """Second level: anchors on the quarters of the half that ``first`` is not on."""
    values = prints.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    on_upper = first.to_numpy(zero_copy_only=False).astype(np.int64) >> 32
    other = np.where(on_upper == 1, values & np.uint64(0xFFFFFFFF), values >> np.uint64(32))
    parts = [_spread(other >> np.uint64(16 * q) & np.uint64(0xFFFF), 15, q) for q in (0, 1)]
    return _lists(np.concatenate([p[0] for p in parts], 1), np.concatenate([p[1] for p in parts], 1))


def _forest(prints: np.ndarray, nodes: np.ndarray, home: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that connect what is linked among one anchor's prints, one fewer than they connect.

    A breadth-first walk: each print taken from the queue is compared with those not yet
    reached, home prints with all and others with home prints, so no list of all pairs arises.
    """
    found = []
    waiting = np.argsort(~home, kind="stable")
    while len(waiting) > 1 and home[waiting[0]]:
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            x = queue.pop()
            near = np.bitwise_count(prints[waiting] ^ prints[x]) <= threshold
            if not home[x]:
                near &= home[waiting]
            if near.any():
                reached = waiting[near]
                found.extend((int(nodes[x]), int(nodes[y])) for y in reached)
                queue.extend(reached)
                waiting = waiting[~near]
    return found


def _links(threshold: int):
    names = ["a", "b"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if rest is not None:
                columns = [np.concatenate([r, c]) for r, c in zip(rest, columns)]
            key, sub = columns[0], columns[1]
            edges = np.flatnonzero((key[1:] != key[:-1]) | (sub[1:] != sub[:-1])) + 1
            if not len(edges):
                rest = columns
                continue
            rest = [c[edges[-1]:].copy() for c in columns]
            yield from groups([c[: edges[-1]] for c in columns], np.concatenate([[0], edges]))
        if rest is not None and len(rest[0]):
            yield from groups(rest, np.array([0, len(rest[0])]))

    def groups(columns, bounds) -> Iterator[pa.RecordBatch]:
        _, _, home, prints, nodes = columns
        prints, home = prints.view(np.uint64), home.astype(bool)
        sizes = np.diff(bounds)
        homes = np.add.reduceat(home.astype(np.int64), bounds[:-1])
        found = []
        for g in np.flatnonzero((sizes > 1) & (homes > 0)):
            part = slice(bounds[g], bounds[g + 1])
            found += _forest(prints[part], nodes[part], home[part], threshold)
        if found:
            table = np.array(found, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(table[:, 0]), pa.array(table[:, 1])], names=names)

    return compare


def linked_prints(prints: DataFrame, threshold: int = THRESHOLD, split_from: int = SPLIT_FROM) -> DataFrame:
    """(a, b): links between ``node`` s whose ``print`` s differ in at most ``threshold`` (up to 3) bits.

    ``prints`` (node, print) has each print once. The links are as few as connect what the
    comparisons at each anchor link, not all pairs.
    """
    if not 0 <= threshold <= THRESHOLD:
        raise ValueError(f"threshold must be 0 to {THRESHOLD}")
    placed = prints.select("node", "print", F.inline(F.arrow_udf(_half_anchors, ANCHORS)("print")))
    hot = written(placed.filter("home").groupBy("anchor").count().filter(F.col("count") >= split_from).select("anchor"))
    rows = placed.select("anchor", F.lit(0).cast("bigint").alias("sub"), "home", "print", "node")
    if not hot.isEmpty():
        marked = rows.join(hot.withColumn("hot", F.lit(True)), "anchor", "left")
        once = marked.filter("hot is null").select(rows.columns)
        # Below a split anchor all prints of a sub-anchor are compared with each other: which of
        # a pair is home may differ between the levels.
        subs = F.explode(F.arrow_udf(_quarter_anchors, ANCHORS)("print", "anchor")).alias("s")
        deep = marked.filter("hot").select("anchor", "print", "node", subs)
        deep = deep.select("anchor", (F.col("s.anchor") + 1).alias("sub"), F.lit(True).alias("home"), "print", "node")
        rows = once.unionByName(deep)
    dealt = rows.repartition("anchor", "sub").sortWithinPartitions("anchor", "sub")
    return dealt.mapInArrow(_links(threshold), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, split_from: int = SPLIT_FROM) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links, the row's own included.
    NULL and empty texts have print 0 and are linked like any other; repeated rows are all
    returned. A row without a doc_id links nothing; it gets the component of the rows of its
    print, NULL if none has an id. Other columns are ignored. No rows give no rows.
    """
    printed = written(docs.select("doc_id", fingerprint(F.col("text")).alias("print")))
    unique = written(printed.groupBy("print").agg(F.min("doc_id").alias("node")))
    named = unique.filter("node is not null")
    parts = components(linked_prints(named, threshold, split_from))
    placed = written(
        unique.join(parts, "node", "left")
        .select(F.col("print").alias("p"), F.coalesce("component", "node").alias("component_id"))
    )
    return printed.join(placed, F.col("print") == F.col("p"), "left").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_per_component(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each component of linked prints, all columns as they were.

    The row with the smallest doc_id stays. Rows under one doc_id are told apart by their prints,
    so texts that are not linked all stay; rows that repeat a doc_id and a print are one, the
    first by their JSON. Rows without a doc_id stay and link nothing. NULL and empty texts have
    print 0 and are linked like any other. No rows give no rows; any column names may clash.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = docs.filter("doc_id is not null").select(row)
    printed = written(named.select(F.col("row.doc_id").alias("doc_id"), fingerprint(F.col("row.text")).alias("print")))
    unique = written(printed.groupBy("print").agg(F.min("doc_id").alias("doc_id")))
    parts = components(linked_prints(unique.select(F.col("print").alias("node"), "print"), threshold))
    grouped = unique.join(parts, F.col("print") == F.col("node"), "left")
    first = F.min(F.struct("doc_id", "print")).alias("first")
    kept = written(grouped.groupBy(F.coalesce("component", "print").alias("part")).agg(first).select("first.*"))
    # Only where an id repeats, its rows' prints decide which of them it is.
    several = written(printed.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("id")))
    ids = kept.select(F.col("doc_id").alias("kept_id"))
    single = named.join(several, F.col("row.doc_id") == F.col("id"), "left_anti")
    single = single.join(ids, F.col("row.doc_id") == F.col("kept_id"), "left_semi").select("row.*")
    if not several.isEmpty():
        rows = named.join(several, F.col("row.doc_id") == F.col("id"), "left_semi").select("row", fingerprint(F.col("row.text")).alias("print"))
        of_first = (F.col("row.doc_id") == F.col("first_id")) & (F.col("print") == F.col("first_print"))
        rows = rows.join(kept.toDF("first_id", "first_print"), of_first, "left_semi")
        rows = rows.groupBy("row.doc_id", "print").agg(F.min_by("row", F.to_json("row")).alias("row"))
        single = single.unionByName(rows.select("row.*"))
    return single.unionByName(docs.filter("doc_id is null"))
