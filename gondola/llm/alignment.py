"""Alignment of two tokenizers' tokens over the bytes of a text.

Both tokenizers cover the same bytes, a space and the text. Where a token of either ends at the
same byte, the text falls into *groups*; within a group tokens are *linked* if their bytes
overlap. A boundary of either tokenizer opens exactly one new overlap, so links are the
segments between neighbouring boundaries of any kind.

Long texts are cut into ranges of bytes, wherever these fall. A range's tokens (those that end
in it) make a *fragment*: an open prefix up to the first common end, the closed groups, and an
open suffix behind the last common end. Fragments compose: the suffix of one and the prefix of
the next become one group. That is associative, so the fragments of a text are composed in a
tree by tasks that know only their own part.

A range is encoded together with the words that reach over its edges. Between words neither
tokenizer can merge (``Pair`` checks the vocabularies for it), so a word's tokens do not depend
on its neighbours, and each task keeps those of the words it saw, up to a bound.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from gondola.session import written

#: Bytes of a range; texts up to this are one range.
RANGE = 1 << 16
#: Fragments that one task composes at once.
FAN = 8
#: Words that a task remembers, and their characters; words that are encoded at once.
WORDS, WORD_CHARS, TOGETHER = 1 << 17, 1 << 22, 1 << 14
#: Bytes of texts that are aligned at once.
BLOCK = 1 << 19
#: Counted pairs that are broadcast at once.
COUNTS = 1 << 20
SHIFT = 20
#: Where neither tokenizer merges: before a space and a printable character, unless more spaces
#: come before it; and before a line end that follows a printable character.
CUT = re.compile(r"(?<![ ▁])(?= [!-~\w])|(?<=[!-~\w])(?=\n)")
PRINTABLE = re.compile(r"[!-~\w]")
#: Characters whose classes no Unicode version changes.
LATIN = re.compile("[\0-\u024f]*")


#: Fixed value: the pattern by which byte-level tokenizers of this kind cut a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokens(NamedTuple):
    """Ids and the byte where each token ends, of both tokenizers."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(x) for x in zip(self, other, strict=True)))

    def between(self, start: int, end: int) -> Tokens:
        """Those that end in (start, end]."""
        a = slice(*np.searchsorted(self.a_end, [start, end], "right"))
        b = slice(*np.searchsorted(self.b_end, [start, end], "right"))
        return Tokens(self.a[a], self.a_end[a], self.b[b], self.b_end[b])


NOTHING = Tokens(*(np.zeros(0, np.int64) for _ in range(4)))


def links(tokens: Tokens) -> np.ndarray:
    """The id pairs of all overlapping tokens, as one number each, in byte order."""
    ends = np.union1d(tokens.a_end, tokens.b_end)
    a = tokens.a[np.searchsorted(tokens.a_end, ends)]
    return a << SHIFT | tokens.b[np.searchsorted(tokens.b_end, ends)]


def groups(tokens: Tokens) -> str:
    """``a1,a2|b1;a3|b2``: ids by group, of tokens that begin and end at common ends."""
    common = np.intersect1d(tokens.a_end, tokens.b_end)
    parts, a, b = [], 0, 0
    a_ids, b_ids = tokens.a.tolist(), tokens.b.tolist()
    a_cuts, b_cuts = (np.searchsorted(x, common, "right").tolist() for x in (tokens.a_end, tokens.b_end))
    for i, j in zip(a_cuts, b_cuts):
        parts.append(",".join(map(str, a_ids[a:i])) + "|" + ",".join(map(str, b_ids[b:j])))
        a, b = i, j
    return ";".join(parts)


def tally(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and how often each comes."""
    if weights is None:
        found, counts = np.unique(keys, return_counts=True)
        return found, counts.astype(np.int64)
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, weights, len(found)).astype(np.int64)


class Fragment(NamedTuple):
    """A range's tokens: open prefix, closed groups, open suffix.

    Without a common end (``split`` false) all tokens are in the prefix. The prefix of a
    split fragment ends at its first common end, so it is a group once what stands left is known.
    """

    same: bool
    split: bool
    prefix: Tokens
    closed: str
    n_a: int
    n_b: int
    n_groups: int
    pairs: np.ndarray
    times: np.ndarray
    suffix: Tokens

    @classmethod
    def of(cls, tokens: Tokens) -> Fragment:
        common = np.intersect1d(tokens.a_end, tokens.b_end)
        if not len(common):
            return EMPTY._replace(prefix=tokens)
        first, last = int(common[0]), int(common[-1])
        middle = tokens.between(first, last)
        return cls(
            True, True, tokens.between(-1, first), groups(middle), len(middle.a), len(middle.b), len(common) - 1,
            *tally(links(middle)), tokens.between(last, 1 << 62),
        )

    def grown(self, closed: str, n_a: int, n_b: int, n_groups: int, pairs: np.ndarray, times: np.ndarray) -> Fragment:
        """Closed groups more, behind a split fragment without a suffix."""
        keys, counts = tally(np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times]))
        text = ";".join(x for x in (self.closed, closed) if x)
        return self._replace(
            closed=text, n_a=self.n_a + n_a, n_b=self.n_b + n_b, n_groups=self.n_groups + n_groups, pairs=keys, times=counts
        )

    def __add__(self, other: Fragment) -> Fragment:
        """The fragment of both ranges together; ``EMPTY`` is neutral and any grouping gives the same."""
        same = self.same and other.same
        if not self.split:
            return other._replace(same=same, prefix=self.prefix + other.prefix)
        if not other.split:
            return self._replace(same=same, suffix=self.suffix + other.prefix)
        return self._closing(self.suffix + other.prefix).grown(
            other.closed, other.n_a, other.n_b, other.n_groups, other.pairs, other.times
        )._replace(same=same, suffix=other.suffix)

    def _closing(self, group: Tokens) -> Fragment:
        return self.grown(groups(group), len(group.a), len(group.b), 1, *tally(links(group)))

    def whole(self) -> Fragment:
        """Of a whole text: the prefix is its first group, no suffix is left."""
        if not self.same or not self.split or len(self.suffix.a) or len(self.suffix.b):
            return EMPTY
        start = EMPTY._replace(split=True)._closing(self.prefix)
        return start.grown(self.closed, self.n_a, self.n_b, self.n_groups, self.pairs, self.times)


_NONE = np.zeros(0, np.int64)
EMPTY = Fragment(True, False, NOTHING, "", 0, 0, 0, _NONE, _NONE, NOTHING)


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones stand for
    themselves, the others for the characters from U+0100 on, in their order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    result = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return result | {chr(256 + i): b for i, b in enumerate(others)}


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))


def _key(piece: str) -> str:
    """A piece between cuts without its first space, if what is left shows that it had one."""
    return piece[1:] if piece[0] == " " and piece[1:2] not in ("", " ", "\n") else piece


class Pair:
    """Two tokenizers and the words seen so far. ``a``: JSON of a byte-level BPE, ``b``: a piece model."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        alphabet = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            a_bytes[i] = bytes(alphabet[c] for c in token) if alphabet.keys() >= set(token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.bytes = (a_bytes, b_bytes)
        self.lengths = tuple(np.array([len(x) for x in names], np.int64) for names in self.bytes)
        self.written = [f"{i}{after}" for i in range(max(map(len, self.bytes))) for after in ",|;"]
        plain = [p for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i) and not self.b.is_unknown(i)]
        data = json.loads(a)
        kind = data.get("pre_tokenizer") or {}
        #: Whether words can be encoded apart: no piece goes over a cut, and A cuts there itself.
        self.apart = (
            kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
            and not data.get("normalizer") and not any(re.search("[^▁]▁|\n", p) for p in plain)
        )
        self.space = self.b.encode("\n")[:1]
        self.quick = self._quick(data, SPLIT) if self.apart else None
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.chars = 0
        self.texts: list[str] = []
        #: By word: tokens of A, of B, groups, bytes; zeros where the tokens' bytes are not the word's.
        self.sizes = np.zeros((0, 4), np.int64)
        self.flat = [*[np.zeros(0, np.int32)] * 4, _NONE]  # ids and ends of A and of B, and links, of all words
        self.starts = np.zeros((1, 3), np.int64)

    def _ids_a(self, pieces: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of all pieces one after the other, and how many each piece has."""
        if self.quick is None:
            ids = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
            return _flat(ids)
        # Words behind spaces are cut apart by A itself, so they are encoded as one text.
        together = [i for i, p in enumerate(pieces) if p[0] == " " and PRINTABLE.match(p[1:2]) and LATIN.fullmatch(p)]
        if len(together) == len(pieces):
            flat = np.array(self.quick.encode_ordinary("".join(pieces)), np.int64)
            ends = np.cumsum(self.lengths[0][flat])
            return flat, np.diff(np.searchsorted(ends, np.cumsum([len(r) for r in raw]), "right"), prepend=0)
        ids = [self.quick.encode_ordinary(p) if LATIN.fullmatch(p) else self.a.encode(p, add_special_tokens=False).ids for p in pieces]
        return _flat(ids)

    def _ids_b(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.b.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1)
        for i, (piece, found) in enumerate(zip(pieces, ids, strict=True)):
            if piece[0] == "\n" and found[:1] == self.space:
                ids[i] = found[1:]  # without the space that the model adds
        return _flat(ids)

    def _quick(self, data: dict, pattern: str):
        """The same tokenizer over ranks, which is faster, or None where it could differ.

        It merges by the rank of what two tokens give together. That is the merge list's order if
        ids follow it and the list makes each token, from its own bytes, into itself: a pair
        that the list cannot merge is then never one that gives a token.
        """
        import tiktoken

        model = data["model"]
        vocabulary = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocabulary.get("".join(p), -1) for p in pairs]
        single = sorted(i for t, i in vocabulary.items() if len(t) == 1)
        rest = {i for t, i in vocabulary.items() if len(t) > 1} - set(made)
        special = {t["id"] for t in data.get("added_tokens", [])}
        if made != sorted(set(made)) or single != list(range(256)) or not rest <= special or made[0] != 256:
            return None
        if any([x.id for x in self.a.model.tokenize(t)] != [i] for t, i in vocabulary.items() if i not in special):
            return None
        ranks = {x: i for i, x in enumerate(self.bytes[0]) if i not in special}
        return tiktoken.Encoding("quick", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def words(self, text: str) -> list[str]:
        """A space and ``text``, cut between words; a word stands without its first space where that is clear."""
        if not self.apart:
            return [" " + text]
        words = text.replace("\n", " \n").split(" ")
        plain = "▁" not in text and self._printable({w[:1] for w in words} - {"\n"})
        if plain and ("\n" not in text or self._printable({w[-1:] for w in words})):
            return words
        return [_key(p) for p in CUT.split(" " + text) if p]

    def _printable(self, characters: set[str]) -> bool:
        return all(map(PRINTABLE.match, characters))

    def learn(self, words: set[str]) -> None:
        """Encode and align the words not yet known, all in one stretch of bytes."""
        new = [w for w in words if w not in self.codes]
        odd = [w for w in new if w[0] in " \n" or not (LATIN.fullmatch(w) and PRINTABLE.match(w))]
        if odd and len(odd) < len(new):
            self.learn(set(odd))
            new = [w for w in new if w not in self.codes]
        for start in range(0, len(new), TOGETHER):
            self._learn(new[start:start + TOGETHER])

    def _learn(self, new: list[str]) -> None:
        pieces = [w if w[0] in " \n" else " " + w for w in new]
        raw = [p.encode() for p in pieces]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        sides = [self._ids_a(pieces, raw), self._ids_b(pieces)]
        good = np.logical_and(*(self._same(*side, names, raw) for side, names in zip(sides, self.bytes)))
        length[~good] = 0
        tokens, counts = [], []
        for (flat, number), sizes in zip(sides, self.lengths):
            flat = flat[np.repeat(good, number)]
            tokens += [flat, np.cumsum(sizes[flat])]
            counts.append(np.where(good, number, 0))
        together, limits = Tokens(*tokens), np.cumsum(length)
        keys, parts = links(together), self.parts(together)
        n_links = np.diff(np.searchsorted(np.union1d(together.a_end, together.b_end), limits, "right"), prepend=0)
        ends = np.cumsum(counts[0] + counts[1]).tolist()
        self.texts += ["".join(parts[i:j])[:-1] for i, j in zip([0, *ends], ends)]
        self.codes |= zip(new, range(len(self.sizes), len(self.sizes) + len(new)))
        self.chars += sum(map(len, new))
        sizes = np.stack([*counts, counts[0] + counts[1] - n_links, length], 1)
        own = [e - np.repeat(limits - length, n) for e, n in zip((together.a_end, together.b_end), counts)]
        fresh = (together.a, own[0], together.b, own[1], keys)
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = [np.concatenate([x, y.astype(np.int32)]) for x, y in zip(self.flat[:4], fresh[:4])] + [np.concatenate([self.flat[4], keys])]
        steps = np.cumsum(np.stack([*counts, n_links], 1), 0)
        self.starts = np.concatenate([self.starts, self.starts[-1] + steps])

    def _same(self, flat: np.ndarray, number: np.ndarray, names: list[bytes], raw: list[bytes]) -> np.ndarray:
        """By piece, whether the tokens' bytes are the piece's."""
        parts = list(map(names.__getitem__, flat.tolist()))
        ends = np.cumsum(number).tolist()
        size = np.cumsum([0, *map(len, parts)])[[0, *ends]]
        if b"".join(parts) == b"".join(raw) and (size[1:] == np.cumsum([len(r) for r in raw])).all():
            return np.ones(len(raw), bool)
        return np.array([b"".join(parts[i:j]) == r for i, j, r in zip([0, *ends], ends, raw)], bool)

    def parts(self, tokens: Tokens) -> list[str]:
        """Each id as text with what follows it, in the order of ``groups``."""
        common = np.intersect1d(tokens.a_end, tokens.b_end, assume_unique=True)
        a, b = (np.searchsorted(common, e) for e in (tokens.a_end, tokens.b_end))
        result = np.empty(len(a) + len(b), np.int64)
        result[np.arange(len(a)) + np.searchsorted(b, a)] = tokens.a * 3 + (common[a] == tokens.a_end)
        result[np.arange(len(b)) + np.searchsorted(a, b, "right")] = tokens.b * 3 + 2 * (common[b] == tokens.b_end)
        return list(map(self.written.__getitem__, result.tolist()))

    def known(self, texts: list[list[str]]) -> None:
        """Learn the words of some texts; forget the earlier ones when they have become too many."""
        words = set().union(*texts)
        if len(self.codes) > WORDS or self.chars > WORD_CHARS:
            self.clear()
        self.learn(words)

    def closed(self, words: list[str]) -> tuple | None:
        """(groups, n_a, n_b, n_groups, pairs, times) of whole words; None where bytes differ."""
        codes = np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[codes]
        if not len(words) or not sizes[:, 0].all():
            return None
        starts, lengths = self.starts[codes, 2], self.starts[codes + 1, 2] - self.starts[codes, 2]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(starts - ends + lengths, lengths)
        n_a, n_b, n_groups, _ = sizes.sum(0).tolist()
        return ";".join(map(self.texts.__getitem__, codes.tolist())), n_a, n_b, n_groups, *tally(self.flat[4][at])

    def fragment(self, context: str, at: int, start: int, end: int) -> Fragment:
        """The fragment of bytes [start, end) of a text; ``context`` are its words that reach in, from byte ``at`` on."""
        words = [_key(w) for w in CUT.split(context) if w] if self.apart else [context]
        self.known([words])
        codes = [self.codes[w] for w in words]
        if not all(self.sizes[codes, 0]):
            return EMPTY._replace(same=False)
        ends = at + np.cumsum(self.sizes[codes, 3])
        begins = np.concatenate([[at], ends[:-1]])
        part = lambda i: Fragment.of(self._moved(codes[i], int(begins[i])).between(start, end))
        result, i = EMPTY, 0
        while i < len(words) and (begins[i] < start or not result.split):
            result, i = result + part(i), i + 1
        last = int(np.searchsorted(ends, end, "right"))
        if last > i and not len(result.suffix.a) and not len(result.suffix.b):
            result, i = result.grown(*self.closed(words[i:last])), last
        for j in range(i, len(words)):
            result = result + part(j)
        return result

    def _moved(self, code: int, by: int) -> Tokens:
        (a, b, _), (a_end, b_end, _) = self.starts[code], self.starts[code + 1]
        ids_a, ends_a, ids_b, ends_b, _ = self.flat
        a, b = slice(a, a_end), slice(b, b_end)
        ids_a, ends_a, ids_b, ends_b = (x.astype(np.int64) for x in (ids_a[a], ends_a[a], ids_b[b], ends_b[b]))
        return Tokens(ids_a, ends_a + by, ids_b, ends_b + by)


@lru_cache(maxsize=1)
def _pair(a: bytes, b: bytes) -> Pair:
    """The tokenizers and the words that a worker process remembers, over its tasks."""
    return Pair(a, b)


def ranges(text: str, size: int = RANGE) -> Iterator[tuple[str, int, int, int]]:
    """(context, at, start, end) of the byte ranges of a space and ``text``.

    A range has ``size`` bytes, cut wherever that falls. Its context are the words that reach
    in, ``at`` their first byte. Only behind a word of more than ``size`` bytes the range is
    moved to the word's end: such a word is encoded once, as a whole.
    """
    raw = (" " + text).encode("utf-8", "replace")
    cuts = _cuts(raw, size)
    start, lead = 0, 0
    while start < len(raw):
        end = min(start + size, len(raw))
        before, after = cuts(end)
        if after - before > size:
            end = before = after
        yield raw[lead:after].decode(), lead, start, end
        start, lead = end, before


#: ``CUT`` on bytes, which sees no letters beyond ASCII and so fewer places.
BYTE_CUT = re.compile(rb"(?<! )(?<!\xe2\x96\x81)(?= [!-~])|(?<=[!-~])(?=\n)")


def _cuts(raw: bytes, size: int):
    def around(place: int) -> tuple[int, int]:
        """The last cut at or before ``place`` and the first at or behind it; the text's ends are cuts."""
        found = BYTE_CUT.search(raw, place) if 0 < place < len(raw) else None
        after = len(raw) if found is None and place > 0 else found.start() if found else 0
        width = 256
        while after != place and place - width > 0:
            low = place - width
            if places := [m.start() for m in BYTE_CUT.finditer(raw, low, place + 2) if low < m.start() <= place]:
                return places[-1], after
            width *= 4
        if after == place:
            return place, place
        places = [m.start() for m in BYTE_CUT.finditer(raw, 0, place + 2) if m.start() <= place]
        return (places[-1] if places else 0), after

    return around


RESULT = "doc_id bigint, groups string, n_a bigint, n_b bigint, n_groups bigint, pairs array<bigint>, times array<bigint>"
RANGES = "doc_id bigint, key bigint, k bigint, context binary, at bigint, start bigint, end bigint"
TOKENS = "array<bigint>"
FRAGMENTS = (
    "doc_id bigint, key bigint, k bigint, same boolean, split boolean, closed string, n_a bigint, n_b bigint, n_groups bigint, "
    "pairs array<bigint>, times array<bigint>, "
    + ", ".join(f"{side}_{name} {TOKENS}" for side in ("prefix", "suffix") for name in Tokens._fields)
)
_ARROW = {"bigint": pa.int64(), "string": pa.large_string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    kinds = [pa.string() if kind == "string" else _ARROW[kind] for _, kind in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[name] for r in rows], kind) for (name, _), kind in zip(fields, kinds)], names=[n for n, _ in fields]
    )


def _row(fragment: Fragment, doc_id, key: int, k: int) -> dict:
    row = fragment._asdict()
    for side in ("prefix", "suffix"):
        row |= {f"{side}_{name}": x for name, x in row.pop(side)._asdict().items()}
    return row | {"doc_id": doc_id, "key": key, "k": k}


def _fragment(row: dict) -> Fragment:
    side = lambda s: Tokens(*(np.array(row[f"{s}_{n}"], np.int64) for n in Tokens._fields))
    pairs, times = np.array(row["pairs"], np.int64), np.array(row["times"], np.int64)
    return Fragment(row["same"], row["split"], side("prefix"), row["closed"], row["n_a"], row["n_b"], row["n_groups"], pairs, times, side("suffix"))


def _result(doc_id, closed: tuple | None) -> dict:
    text, n_a, n_b, n_groups, pairs, times = closed or ("", 0, 0, 0, _NONE, _NONE)
    return {"doc_id": doc_id, "groups": text, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "pairs": pairs, "times": times}




def aligned(docs: DataFrame, a: str, b: str, size: int = RANGE, fan: int = FAN) -> DataFrame:
    """The alignment of each text of ``docs`` (doc_id, text), one row per row, in any order.

    ``a``, ``b``: paths, on the driver, of a byte-level BPE in JSON and of a piece model.
    Returns doc_id, groups (``a1,a2|b1;a3|b2,b3``), n_a, n_b, n_groups, and the different
    linked id pairs (``pairs``, A's id shifted left by 20 bits plus B's) with the number of
    links of each (``times``). NULL and empty texts, and texts whose tokens do not give their
    bytes, have no tokens: empty groups, zeros, no pairs. Repeated rows and NULL ids are rows
    like others; other columns are ignored. Texts of more than ``size`` bytes are cut into
    ranges that any task may take.
    """
    spark = docs.sparkSession
    models = spark.sparkContext.broadcast((Path(a).read_bytes(), Path(b).read_bytes()))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    length = F.coalesce(F.octet_length("text"), F.lit(0))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*models.value)
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1).fill_null(b"")).to_numpy(zero_copy_only=False)) // BLOCK
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
            for part in (batch.slice(i, j - i) for i, j in zip(cuts, cuts[1:]) if j > i):
                raw = [t or b"" for t in part.column(1).to_pylist()]
                texts = [t.decode("utf-8", "replace") for t in raw]
                words = [pair.words(t) if t and t.encode() == r else [] for t, r in zip(texts, raw)]
                pair.known(words)
                yield _batch([_result(d, pair.closed(w)) for d, w in zip(part.column(0).to_pylist(), words)], RESULT)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = raw.decode("utf-8", "replace")
                if text.encode() != raw:
                    text = ""  # one range whose bytes cannot agree
                for k, (context, at, start, end) in enumerate(ranges(text, size)):
                    row = {"doc_id": doc_id, "key": key, "k": k, "context": context.encode(), "at": at, "start": start, "end": end}
                    yield _batch([row], RANGES)

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*models.value)
        for batch in batches:
            for r in batch.to_pylist():
                found = pair.fragment(r["context"].decode(), r["at"], r["start"], r["end"])
                yield _batch([_row(found, r["doc_id"], r["key"], r["k"])], FRAGMENTS)

    def compose(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["k"])
        total = EMPTY
        for r in rows:
            total = total + _fragment(r)
        batch = _batch([_row(total, rows[0]["doc_id"], rows[0]["key"], rows[0]["k"] // fan)], FRAGMENTS)
        return pa.Table.from_batches([batch])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                whole = _fragment(r).whole()
                yield _batch([_result(r["doc_id"], (whole.closed, whole.n_a, whole.n_b, whole.n_groups, whole.pairs, whole.times))], RESULT)

    binary = F.col("text").cast("binary").alias("text")
    result = rows.filter(length <= size).select("doc_id", binary).mapInArrow(short, RESULT)
    long = rows.filter(length > size).select("doc_id", F.monotonically_increasing_id().alias("key"), binary)
    parts = written(long.mapInArrow(cut, RANGES))
    last = parts.agg(F.max("k")).first()[0]
    if last is None:
        return result
    tree = written(parts.repartition("key", "k").mapInArrow(fragments, FRAGMENTS))
    while last > 0:
        tree = tree.withColumn("slot", F.floor(F.col("k") / fan)).groupBy("key", "slot").applyInArrow(
            lambda table: compose((), table.drop_columns(["slot"])), FRAGMENTS
        )
        last //= fan
    return result.unionByName(tree.mapInArrow(finish, RESULT))


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): in how many rows of ``links`` (pairs) each pair is, and whether none of its A id is in more."""
    counts = links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    # A window holds the pairs of one A id, at most as many as B has ids.
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", SHIFT)))
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


def report(docs: DataFrame, a: str, b: str, at_once: int = COUNTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Pairs are counted over all documents, by rows that hold them. The counts are looked up by
    broadcasting at most ``at_once`` of them; if there are more, in as many passes over the
    stored pairs, whose sums add up. Texts without tokens have zeros and the empty string.
    """
    rows = aligned(docs, a, b).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", "pairs", "times",
        F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
    )
    rows = written(rows)
    counts = written(pair_counts(rows))
    passes = -(-counts.count() // at_once)
    single = rows.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    sums = None
    for i in range(passes):
        some = counts if passes == 1 else counts.filter(F.pmod(F.hash("pair"), F.lit(passes)) == i)
        found = single.join(F.broadcast(some), "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
        sums = found if sums is None else sums.unionByName(found)
    values = ["n_best", "count_sum"]
    if sums is None:
        rows = rows.withColumns({v: F.lit(0).cast("long") for v in values})
    else:
        if passes > 1:
            sums = sums.groupBy("row").agg(*[F.sum(v).alias(v) for v in values])
        rows = rows.join(sums, "row", "left").fillna(0, values)
    n_links = F.col("n_a") + F.col("n_b") - F.col("n_groups")
    return rows.select("doc_id", "n_a", "n_b", "n_groups", n_links.alias("n_links"), *values, "groups_sha256")
