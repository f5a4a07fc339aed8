"""Text cleaning.

Functions that use a value more than once take it stripped. Callers strip in a
``select`` of its own, so that the value is computed once and not once per use.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column, functions as F

# Every code point Python counts as white space; Spark's trim() knows only U+0020.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
SPACE_CLASS = r"(?U)[\s\x1c-\x1f]"

# Cell texts that stand for a missing value.
MISSING_TEXTS = ("", "nan", "none")


def strip(text: Column) -> Column:
    """Remove leading and trailing white space, NBSP and other Unicode spaces included."""
    return F.btrim(text, F.lit(WHITESPACE))


def known(text: Column) -> Column:
    """NULL for an empty text and for the spelled-out missing markers, of stripped text."""
    return F.when(~F.lower(text).isin(*MISSING_TEXTS), text)


def missing_to_null(text: Column) -> Column:
    """NULL for blank cells and for the spelled-out missing markers; else unchanged."""
    markers = "|".join(m for m in MISSING_TEXTS if m)
    space = SPACE_CLASS.removeprefix("(?U)") + "*"
    return F.when(~text.rlike(f"(?iU)^{space}({markers})?{space}$"), text)


def upper_trim(text: Column) -> Column:
    """Strip, collapse inner white space to one space, upper-case."""
    return F.upper(F.trim(F.regexp_replace(text, SPACE_CLASS + "+", " ")))


def match_key(text: Column) -> Column:
    """Key used to compare names: stripped and upper-cased."""
    return F.upper(strip(text))


def safe_text(value: Column) -> Column:
    """Any value as stripped text without a trailing ``.0``; NULL stays NULL."""
    return F.regexp_replace(strip(value.cast("string")), r"^([+-]?\d+)\.0$", "$1")


def _plain(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))


def plain_text(text: str) -> str:
    """Accents off, for names handled on the driver (headers)."""
    return _plain(text)


#: No character beyond has a decomposition or a combining class.
_LAST = 0x30000


@functools.cache
def _decompositions() -> tuple[str, str, str, tuple[str, ...]]:
    """From the Unicode data: characters that become one other or none, what they become (nothing for
    those at the end), and characters that become several, with their first, second, ... characters
    (fewer for those at the end)."""
    changed = {}
    for code in range(0x80, _LAST):
        ch = chr(code)
        if not 0xD800 <= code < 0xE000 and (base := _plain(ch)) != ch:
            changed[ch] = base
    single = sorted((ch for ch, base in changed.items() if len(base) < 2), key=lambda ch: not changed[ch])
    several = sorted((ch for ch, base in changed.items() if len(base) > 1), key=lambda ch: -len(changed[ch]))
    most = max(map(len, changed.values()))
    places = tuple("".join(changed[ch][i] for ch in several if len(changed[ch]) > i) for i in range(most))
    return "".join(single), "".join(changed[ch] for ch in single), "".join(several), places


def _character_class(characters: str) -> str:
    """A pattern for any of some characters, as ranges."""
    codes, parts = sorted(map(ord, characters)), []
    start = last = codes[0]
    for code in [*codes[1:], -1]:
        if code != last + 1:
            parts.append(f"\\x{{{start:X}}}-\\x{{{last:X}}}")
            start = code
        last = code
    return "[" + "".join(parts) + "]"


def strip_accents(text: Column) -> Column:
    """Compatibility-decompose and drop characters with a combining class, in every script."""
    single, plain, several, places = _decompositions()
    once = F.translate(text, single, plain)
    # One character becomes the concatenation of its first, second, ... characters.
    spread = F.transform(F.split(once, ""), lambda ch: F.when(
        ch.rlike(_character_class(several)), F.concat(*[F.translate(ch, several, p) for p in places])).otherwise(ch))
    rare = F.when(once.rlike(_character_class(several)), F.array_join(spread, "")).otherwise(once)
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(rare)
