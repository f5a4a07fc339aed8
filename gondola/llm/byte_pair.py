"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

The leaves of the tree are the byte positions of one piece of text; a leaf holds the rank of
the pair that starts there (or none), an inner node the smallest rank below it and, as ties go
left, its leftmost position. A merge takes the root's position, joins the token there with its
right neighbour in a linked list of live tokens, and updates three leaves: the merged token's,
its left neighbour's and the removed one's, each in a logarithmic number of steps.

Pieces of one batch that are new are merged together, one tree row each, in numpy; long
pieces one by one. Finished pieces are kept in a bounded table per task.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import itertools
import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gondola.llm.common import per_text, struct_array

NONE = np.int64(1) << 40
#: Pieces of more bytes are merged one by one.
ROW_LIMIT = 64
#: Finished pieces kept per task; the table is emptied when it is full.
KEPT_PIECES = 250_000
ROWS_AT_ONCE = 4096


def read_ranks(path: str) -> bytes:
    """The rank file's bytes, read on the driver: lines of base64 token and rank."""
    with open(path, "rb") as file:
        return file.read()


class Vocabulary:
    """Ranks of tokens, and of the pairs of tokens that join to one."""

    def __init__(self, ranks: bytes):
        self.ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.width = max(self.ids.values(), default=0) + 1
        self.tokens = [b""] * self.width
        for token, rank in self.ids.items():
            self.tokens[rank] = token
        self.bytes = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        get = self.ids.get
        self.pairs = {
            a * self.width + b: rank
            for token, rank in self.ids.items()
            for cut in range(1, len(token))
            if (a := get(token[:cut])) is not None and (b := get(token[cut:])) is not None
        }
        self._build_table()

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _build_table(self) -> None:
        """An open-addressed table of the pairs, so that numpy looks up many at once."""
        keys = np.fromiter(self.pairs.keys(), np.int64, len(self.pairs))
        values = np.fromiter(self.pairs.values(), np.int64, len(self.pairs))
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            won = self.keys[slots] == keys
            self.values[slots[won]] = values[won]
            keys, values, slots = keys[~won], values[~won], slots[~won] + 1 & len(self.keys) - 1

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; NONE where it joins to no token or either side is none (-1)."""
        keys = np.where((left >= 0) & (right >= 0), left * self.width + right, -2)
        slots = self._slots(keys)
        held = self.keys[slots]
        result = np.where(held == keys, self.values[slots], NONE)
        more = np.flatnonzero((held != keys) & (held >= 0) & (keys >= 0))
        slots = slots[more]
        while len(more):
            slots = slots + 1 & len(self.keys) - 1
            held = self.keys[slots]
            hit = held == keys[more]
            result[more[hit]] = self.values[slots[hit]]
            on = ~hit & (held >= 0)
            more, slots = more[on], slots[on]
        return result

    def merge_rows(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids, as little-endian unsigned 32-bit numbers, of pieces of ROW_LIMIT bytes at most, one segment tree per row."""
        lengths = np.array([len(p) for p in pieces])
        width = max(2, 1 << int(lengths.max() - 1).bit_length())
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        columns, rows = np.arange(width), np.arange(len(pieces))
        tokens = np.where(columns < lengths[:, None], self.bytes[raw], -1)
        # In the lists place 0 stands for "before the first", width + 1 for "after the last".
        ahead = np.tile(np.arange(1, width + 3), (len(pieces), 1))
        behind = np.tile(np.arange(-1, width + 1), (len(pieces), 1))
        held = np.full((len(pieces), width + 2), -1, np.int64)
        held[:, 1:-1] = tokens
        tree = np.full((len(pieces), 2 * width), NONE * (width + 1), np.int64)
        first = self.pair_ranks(held[:, 1:-1].ravel(), held[:, 2:].ravel()).reshape(-1, width)
        # A node holds rank and position in one number, so the smallest is the leftmost smallest.
        tree[:, width:] = first * width + columns
        level = width // 2
        while level:
            tree[:, level: 2 * level] = np.minimum(tree[:, 2 * level: 4 * level: 2], tree[:, 2 * level + 1: 4 * level: 2])
            level //= 2
        live = rows[tree[:, 1] < NONE * width]
        while len(live):
            root = tree[live, 1]
            rank, place = root // width, root % width + 1
            gone = ahead[live, place]
            after, before = ahead[live, gone], behind[live, place]
            held[live, place], held[live, gone] = rank, -1
            ahead[live, place] = after
            inside = after <= width + 1
            behind[live[inside], after[inside]] = place[inside]
            right = held[live, np.minimum(after, width + 1)]
            changes = (
                (gone, np.full(len(live), NONE)),
                (place, self.pair_ranks(rank, right)),
                (before, self.pair_ranks(held[live, before], rank)),
            )
            for at, value in changes:
                real = at >= 1
                self._update(tree, live[real], at[real] - 1, value[real], width)
            live = live[tree[live, 1] < NONE * width]
        body = held[:, 1:-1]
        ids = body[body >= 0].astype("<u4").tobytes()
        ends = (np.cumsum((body >= 0).sum(1)) * 4).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    @staticmethod
    def _update(tree: np.ndarray, rows: np.ndarray, leaf: np.ndarray, rank: np.ndarray, width: int) -> None:
        node = leaf + width
        tree[rows, node] = rank * width + leaf
        while width > 1:
            node, width = node >> 1, width >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def merge_long(self, piece: bytes) -> bytes:
        """Token ids of one piece of any length, with one tree in plain lists."""
        size = len(piece)
        width = 1 << max(1, (size - 1).bit_length())
        none, pairs, span = int(NONE) * width, self.pairs, self.width
        held = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        ahead, behind = list(range(1, size + 1)), list(range(-1, size - 1))
        tree = np.full(2 * width, none, np.int64)
        ids = np.array(held)
        if size > 1:
            tree[width: width + size - 1] = self.pair_ranks(ids[:-1], ids[1:]) * width + np.arange(size - 1)
        level = width // 2
        while level:
            tree[level: 2 * level] = np.minimum(tree[2 * level: 4 * level: 2], tree[2 * level + 1: 4 * level: 2])
            level //= 2
        tree = tree.tolist()

        def update(leaf: int, rank: int | None) -> None:
            node = leaf + width
            tree[node] = none if rank is None else rank * width + leaf
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b
                node >>= 1

        while tree[1] < none:
            rank, place = divmod(tree[1], width)
            gone, before = ahead[place], behind[place]
            after = ahead[gone]
            held[place], held[gone], ahead[place] = rank, -1, after
            update(gone, None)
            if after < size:
                behind[after] = place
            update(place, pairs.get(rank * span + held[after]) if after < size else None)
            if before >= 0:
                update(before, pairs.get(held[before] * span + rank))
        return np.array([t for t in held if t >= 0], "<u4").tobytes()

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids of each piece, in order."""
        done = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if piece in self.ids:
                done[i] = self.ids[piece].to_bytes(4, "little")
            elif len(piece) > ROW_LIMIT:
                done[i] = self.merge_long(piece)
            elif piece:
                by_width.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for places in by_width.values():
            for start in range(0, len(places), ROWS_AT_ONCE):
                block = places[start: start + ROWS_AT_ONCE]
                for i, ids in zip(block, self.merge_rows([pieces[i] for i in block])):
                    done[i] = ids
        return done


class Encoder:
    """Texts to token ids, as little-endian unsigned 32-bit bytes, and back to bytes.

    Where no two white-space characters follow each other, a piece never reaches over a line
    break and starts at every space; such texts are taken apart at spaces and line breaks, and
    the ids of each part are looked up as a whole. The pattern itself splits each new part, and
    every other text. Such parts hold for patterns that, like the given one, keep a white-space
    run apart but for one space before the next word.
    """

    def __init__(self, ranks: bytes, pattern: str, kept: int = KEPT_PIECES):
        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self.doubled = re.compile(r"\s\s").search
        self.kept, self.pieces, self.parts = kept, {}, {}
        self.tokens = self.vocabulary.tokens
        # Whether the pattern takes a space and letters, of any script, as one piece.
        self.words_whole = self.split(" aÉß字ʰ") == [" aÉß字ʰ"]

    def encode(self, texts: list[str]) -> list[bytes]:
        """A part is kept by its text where a space stands before it, else marked by a leading line break."""
        plain = [None if self.doubled(t) else t.split("\n") for t in texts]
        wanted: set[str] = {"\n"}
        for lines in plain:
            for line in lines or ():
                parts = line.split(" ")
                parts[0] = "\n" + parts[0]
                wanted.update(parts)
        self.learn_parts(wanted)
        split = [self.split(t) if lines is None else None for t, lines in zip(texts, plain)]
        self.learn_pieces(set(itertools.chain.from_iterable(filter(None, split))))
        ids, result = self.parts.__getitem__, []
        for lines, pieces in zip(plain, split):
            if lines is None:
                result.append(b"".join(map(self.pieces.__getitem__, pieces)))
                continue
            made = []
            for line in lines:
                parts = line.split(" ")
                parts[0] = "\n" + parts[0]
                made.append(b"".join(map(ids, parts)))
            result.append(self.line_break.join(made))
        return result

    def learn_parts(self, wanted: set[str]) -> None:
        """Make all parts known; when the table is full, only those of this block stay."""
        new = [p for p in wanted if p not in self.parts]
        if len(self.parts) + len(new) > self.kept:
            self.parts = {p: self.parts[p] for p in wanted if p in self.parts}
        split = [self.split_part(p) for p in new]
        self.learn_pieces({*itertools.chain.from_iterable(split), "\n"})
        self.line_break = self.pieces["\n"]
        ids = self.pieces.__getitem__
        self.parts.update((p, b"".join(map(ids, pieces))) for p, pieces in zip(new, split))

    def split_part(self, part: str) -> list[str]:
        text = part[1:] if part[:1] == "\n" else " " + part
        return [text] if part.isalpha() and self.words_whole else self.split(text)

    def learn_pieces(self, wanted: set[str]) -> None:
        new = [p for p in wanted if p not in self.pieces]
        if len(self.pieces) + len(new) > self.kept:
            self.pieces = {p: self.pieces[p] for p in wanted if p in self.pieces}
        merged = self.vocabulary.merge([p.encode("utf-8", "surrogatepass") for p in new])
        self.pieces.update(zip(new, merged))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class Ranks:
    """What is broadcast: the rank file's bytes. A worker keeps the encoder it makes of them between its
    tasks and as long as the broadcast, so later stages' tasks in the same worker don't find its tables."""

    def __init__(self, ranks: bytes):
        self.ranks, self.made = ranks, None

    def encoder(self, pattern: str) -> Encoder:
        if self.made is None:
            self.made = Encoder(self.ranks, pattern)
        return self.made


#: Texts that are decoded, and characters that are taken apart, at once.
ROWS, BLOCK_CHARS = 1000, 2_000_000


def _blocks(texts: list[str]) -> Iterable[list[str]]:
    block, chars = [], 0
    for text in texts:
        block.append(text)
        chars += len(text)
        if chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def _with_encoder(spark: SparkSession, ranks_path: str, pattern: str, use: Callable[[Encoder, bytes], tuple], fields: dict):
    shared = spark.sparkContext.broadcast(Ranks(read_ranks(ranks_path)))
    types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}

    def made():
        encoder = shared.value.encoder(pattern)

        def run(texts: list[str]) -> pa.Array:
            rows = []
            gc.disable()  # The tables hold no cycles, and the collector would walk them again and again.
            try:
                for block in _blocks(texts):
                    rows.extend(use(encoder, ids) for ids in encoder.encode(block))
            finally:
                gc.enable()
            columns = zip(*rows) if rows else [[] for _ in fields]
            return struct_array(**{n: pa.array(c, types[t]) for (n, t), c in zip(fields.items(), columns)})

        return run

    return made, "struct<" + ",".join(f"{n}:{t}" for n, t in fields.items()) + ">"


def _tokens(encoder: Encoder, ids: bytes) -> tuple:
    return np.frombuffer(ids, "<i4"), encoder.decode(ids)


def _digests(encoder: Encoder, ids: bytes) -> tuple:
    decoded = encoder.decode(ids)
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


def encoded(spark: SparkSession, text: Column, ranks_path: str, pattern: str) -> Column:
    """struct(ids array<int>, decoded binary): the text's token ids and the bytes they decode to.

    Each match of ``pattern`` is merged by itself by the ranks of the file; no special tokens.
    NULL and empty texts have no tokens. Any length is taken whole.
    """
    return per_text(*_with_encoder(spark, ranks_path, pattern, _tokens, {"ids": "array<int>", "decoded": "binary"}), text, ROWS)


def digests(spark: SparkSession, text: Column, ranks_path: str, pattern: str) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256) of the same, without moving the ids to the JVM."""
    fields = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return per_text(*_with_encoder(spark, ranks_path, pattern, _digests, fields), text, ROWS)


def decode_ids(spark: SparkSession, ids: Column, ranks_path: str) -> Column:
    """The bytes that an array of token ids stands for; ids outside the vocabulary raise."""
    shared = spark.sparkContext.broadcast(Ranks(read_ranks(ranks_path)))

    @F.arrow_udf("binary")
    def apply(batch: pa.Array) -> pa.Array:
        tokens = shared.value.encoder("").vocabulary.tokens
        return pa.array([None if row is None else b"".join(tokens[i] for i in row) for row in batch.to_pylist()], pa.binary())

    return apply(ids)


def token_report(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256."""
    made = digests(docs.sparkSession, F.col("text"), ranks_path, pattern)
    return docs.select("doc_id", made.alias("made")).select("doc_id", "made.*")
