"""Secrets in texts: fixed patterns, and values in a credential's place that would be hard to guess.

The cost of guessing a value is the least product, over all ways to cut it into pieces, of the
guesses each piece takes: common words, dates, repeats, keyboard walks, sequences, or brute
force over the letters seen. The least is found by dynamic programming over end positions.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm.common import per_text, struct_array

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
#: Where a credential's value stands: a naming word, a sign, the value.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|(?<![a-z0-9])pin|secret|token|api_?key|credential|auth|bearer|private_?key|access_?key)s?"""
    r"""["']?\s{0,3}(?:[:=]|=>|\bis\b)\s{0,3}["'<]?([^\s"'<>,;]+)""", re.I | re.A)
CONTEXT_HINTS = ("pass", "pwd", "pin", "secret", "token", "key", "credential", "auth", "bearer")
#: Powers of ten of guesses from which a value counts as a secret.
HARD = 10.0
#: The same for values of letters in one case, which may be words of any language.
HARD_LETTERS = 25.0
#: How far inside a run a piece may start, and the longest value whose cost is remembered.
INSIDE, REMEMBERED = 16, 64

# Words that guessers try first, most common first, and rows of the keyboard.
WORDS = (
    "password", "123456", "qwerty", "admin", "welcome", "letmein", "monkey", "dragon", "master", "login", "secret", "token", "user",
    "test", "guest", "root", "hello", "love", "abc", "pass", "change", "me", "changeme", "example", "default", "sample", "your", "my",
    "the", "and", "key", "api", "here", "value", "string", "name", "database", "server", "local", "host", "none", "null", "true", "false",
    "summer", "winter", "spring", "autumn", "sunshine", "princess", "football", "baseball", "shadow", "super", "star", "world", "dev",
    "prod", "staging", "company", "office", "home", "mail", "email", "account", "access", "private", "public", "temp", "data", "blue",
    "red", "green", "black", "white", "angel", "friend", "family", "money", "power", "magic", "happy", "lucky", "secure", "safe", "one",
)
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
SWAPS = str.maketrans("@430!1$57", "aaeoiisst")

RANK = {w: i + 1 for i, w in enumerate(WORDS)}
LONGEST_WORD = max(map(len, WORDS))
PLACE = {c: (row, col) for row, line in enumerate(ROWS) for col, c in enumerate(line)}
DATE = re.compile(r"(?:(?:19|20)\d\d(?:[-/._]?(?:0?[1-9]|1[0-2])(?:[-/._]?(?:0?[1-9]|[12]\d|3[01]))?)?)|(?:(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:(?:19|20)\d\d))")
LONGEST_DATE = 10


def _brute(letters: str) -> float:
    """Powers of ten that one letter of brute force costs, by the classes of letters seen."""
    pool = 26 * any(c.islower() for c in letters) + 26 * any(c.isupper() for c in letters)
    pool += 10 * any(c.isdigit() for c in letters) + 33 * any(not c.isalnum() for c in letters)
    return math.log10(max(10, pool))


def _word_cost(piece: str) -> float | None:
    lowered = piece.lower()
    plain = lowered.translate(SWAPS)
    rank = RANK.get(lowered) or RANK.get(plain)
    if rank is None:
        return None
    cost = math.log10(rank + 1)
    if piece != lowered:
        cost += math.log10(2 if piece in (piece.capitalize(), piece.upper()) else 2 ** sum(c.isupper() for c in piece))
    return cost + (0 if lowered in RANK else math.log10(2) * sum(a != b for a, b in zip(lowered, plain)))


def _runs(value: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the longest repeats, sequences and keyboard walks of three letters or more."""
    lowered, found = value.lower(), []
    tests = (
        ("repeat", lambda a, b, d: a == b and 0),
        ("sequence", lambda a, b, d: (step := ord(b) - ord(a)) in (1, -1) and step),
        ("walk", lambda a, b, d: _beside(a, b)),
    )
    for kind, test in tests:
        start, direction = 0, None
        for i in range(1, len(lowered) + 1):
            step = test(lowered[i - 1], lowered[i], direction) if i < len(lowered) else False
            good = step is not False and (direction in (None, step) or kind == "walk")
            if not good:
                if i - start >= 3:
                    found.append((start, i, kind))
                start, direction = i - 1, None
                step = test(lowered[i - 1], lowered[i], None) if i < len(lowered) else False
                good = step is not False
                if not good:
                    start = i
            direction = step if good else None
    return found


def _beside(a: str, b: str):
    if a not in PLACE or b not in PLACE or a == b:
        return False
    (r, c), (s, d) = PLACE[a], PLACE[b]
    return 1 if abs(r - s) <= 1 and abs(c - d) <= 1 else False


def _repeated_block(value: str, start: int, end: int) -> int:
    """Length of the shortest block whose repetition the span is, or 0."""
    piece = value[start:end]
    size = (piece + piece).find(piece, 1)
    return size if size < len(piece) else 0


def guess_cost(value: str) -> float:
    """Powers of ten of guesses for ``value``: the cheapest segmentation. Empty costs nothing.

    Words and dates are tried at every start, and every part of a run that starts in its first
    ``INSIDE`` letters, further than any word or date reaches into it; a value of one block
    repeated may also cost the block and the count. Work grows with the length.
    """
    return _short_cost(value) if len(value) <= REMEMBERED else _cost(value)


def piece_costs(value: str) -> dict[int, list[tuple[int, float]]]:
    """By end, the start and cost of every word and date."""
    ends: dict[int, list[tuple[int, float]]] = {}
    for start in range(len(value)):
        for end in range(start + 2, min(len(value), start + LONGEST_WORD) + 1):
            cost = _word_cost(value[start:end])
            if cost is not None:
                ends.setdefault(end, []).append((start, cost))
        date = DATE.match(value, start)
        if date and date.end() - start >= 4:
            ends.setdefault(date.end(), []).append((start, 2.1 if date.end() - start == 4 else 4.6))
    return ends


def run_ends(value: str) -> dict[int, list[tuple[int, str]]]:
    """By end, the first letter and kind of every run that a piece may take a part of."""
    ends: dict[int, list[tuple[int, str]]] = {}
    for first, end, kind in _runs(value):
        for stop in range(first + 3, end + 1):
            ends.setdefault(stop, []).append((first, kind))
    return ends


def _run_cost(kind: str, length: int) -> float:
    turns = 0.35 * length if kind == "walk" else 0.0
    return math.log10(47 * 6 if kind == "walk" else 12) + math.log10(length) + turns


def _cost(value: str) -> float:
    if not value:
        return 0.0
    brute, ends, runs = _brute(value), piece_costs(value), run_ends(value)
    best = [0.0] * (len(value) + 1)
    for end in range(1, len(value) + 1):
        cost = best[end - 1] + brute
        for start, piece in ends.get(end, ()):
            cost = min(cost, best[start] + piece + 0.3)
        for first, kind in runs.get(end, ()):
            for start in range(first, min(end - 3, first + INSIDE) + 1):
                cost = min(cost, best[start] + _run_cost(kind, end - start) + 0.3)
        best[end] = cost
    size = _repeated_block(value, 0, len(value))
    return min(best[-1], guess_cost(value[:size]) + math.log10(len(value) // size)) if size else best[-1]


_short_cost = lru_cache(maxsize=20_000)(_cost)


def is_hard(value: str, hard: float = HARD) -> bool:
    """Whether guessing takes at least ``hard`` powers of ten; of letters in one case ``HARD_LETTERS``."""
    plain = value.isalpha() and value in (value.lower(), value.upper(), value.capitalize())
    return guess_cost(value) >= (max(hard, HARD_LETTERS) if plain else hard)


def spans(text: str, hard: float = HARD) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind in the order of KINDS."""
    found, lowered = [], text.lower()
    if any(hint in lowered for hint in ASSIGN_HINTS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if any(hint in lowered for hint in CONTEXT_HINTS):
        base = list(found)
        for m in CONTEXT.finditer(text):
            covered = any(start <= m.start(1) and m.end(1) <= end for _, start, end in base)
            if not covered and is_hard(m[1], hard):
                found.append(("guess", m.start(1), m.end(1)))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


FIELDS = "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,spans:string>"


def _report(texts: list[str]) -> pa.Array:
    rows = []
    for text in texts:
        found = spans(text)
        base = [s for s in found if s[0] != "guess"]
        counts = [sum(s[0] == kind for s in base) for kind in KINDS[:3]]
        rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(found)))
    columns = list(zip(*rows)) or [()] * 5
    types = [pa.int64()] * 3 + [pa.string()] * 2
    names = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")
    return struct_array(**{n: pa.array(c, t) for n, c, t in zip(names, columns, types)})


def found_spans(text: Column) -> Column:
    """array of struct(kind, start, end): the secrets in each text, NULL and empty texts none."""

    def made():
        def run(texts: list[str]) -> pa.Array:
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(t)] for t in texts]
            return pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))

        return run

    return per_text(made, "array<struct<kind:string,start:bigint,end:bigint>>", text)


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, counts by base kind, the base spans' digest and all spans.

    Texts are read whole. Repeated rows are all returned; other columns are ignored; no rows give no rows.
    """
    made = per_text(lambda: _report, FIELDS, F.col("text"))
    return docs.select("doc_id", made.alias("made")).select("doc_id", "made.*")
