"""Number and code parsing, of stripped text (see ``functions.text``).

Unparsable text becomes NULL, or 0 where said, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gondola.functions.text import MISSING_TEXTS, WHITESPACE

# A finite decimal number. try_cast alone would also take "1d", "1f" and "Infinity".
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Only what a number may contain, one digit at least: for these texts try_cast is exact.
NUMBER_MARKS = r"(?U)^[.,+\-eE\s\x1c-\x1f]*[0-9][0-9.,+\-eE\s\x1c-\x1f]*$"
SCIENTIFIC = r"^(\d+)(?:\.(\d+))?[eE]([+-]?\d+)$"
#: Longest integer that scientific notation may stand for; a longer one is no code.
MOST_DIGITS = 10_000
INTEGER = r"^\d+(\.0)?$"


def plain_number(text: Column) -> Column:
    """Double from number text with a decimal point; anything else is NULL."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def is_bad_number(text: Column) -> Column:
    """True for text that is neither missing nor a number. Never NULL."""
    return F.coalesce(~F.lower(text).isin(*MISSING_TEXTS) & ~text.rlike(NUMBER), F.lit(False))


def number_or_zero(text: Column) -> Column:
    """Spanish number for measures; missing and unparsable give 0.

    With both marks present the dot groups thousands and the comma is decimal;
    with one mark alone that mark is decimal: ``56.000,75`` is 56000.75 and
    ``1.500`` is 1.5. (For amounts see ``thousands_number``.)
    """
    both = text.contains(".") & text.contains(",")
    grouped = F.when(both, F.replace(text, F.lit("."), F.lit(""))).otherwise(text)
    digits = F.regexp_replace(F.translate(grouped, ",", "."), r"[^0-9.\-]", "")
    # Text without a digit is common and a failing cast is slow.
    return F.coalesce(F.when(text.rlike("[0-9]"), digits.try_cast("double")), F.lit(0.0))


def thousands_number(text: Column) -> Column:
    """Spanish number for amounts: every dot groups thousands, ``1.500`` is 1500."""
    value = F.translate(text, ",." + WHITESPACE, ".")
    return F.when(text.rlike(NUMBER_MARKS), value.try_cast("double"))


def whole_number(text: Column) -> Column:
    """Number text as a nullable integer, fraction cut."""
    return plain_number(text).try_cast("bigint")


def _expanded(text: Column) -> Column:
    """Exact integer of scientific notation, fraction cut; NULL beyond MOST_DIGITS digits.

    Moves the decimal point in the digit string, so no precision is lost.
    """
    whole = F.regexp_extract(text, SCIENTIFIC, 1)
    fraction = F.regexp_extract(text, SCIENTIFIC, 2)
    sign = F.when(F.regexp_extract(text, SCIENTIFIC, 3).startswith("-"), -MOST_DIGITS * 2).otherwise(MOST_DIGITS * 2)
    # An exponent of more digits than a long holds is as good as a very large one.
    exponent = F.coalesce(F.regexp_extract(text, SCIENTIFIC, 3).try_cast("bigint"), sign.cast("bigint"))
    length = F.length(whole) + F.greatest(F.least(exponent, F.lit(1 << 40)), F.lit(-(1 << 40)))
    digits = F.concat(whole, fraction)
    moved = F.when(length <= 0, F.lit("0")).when(length <= MOST_DIGITS, F.rpad(digits, length.cast("int"), "0"))
    return without_leading_zeros(moved)


def without_leading_zeros(digits: Column) -> Column:
    return F.regexp_replace(digits, r"^0+(?=\d)", "")


def barcode_digits(text: Column) -> Column:
    """Digits of a product code as stable text.

    Scientific notation becomes the exact integer; otherwise one trailing
    ``.0`` goes and only digits stay, leading zeros included. No digits: NULL.
    """
    digits = F.regexp_replace(text, r"\.0$|[^0-9]", "")
    return F.when(text.rlike(SCIENTIFIC), _expanded(text)).when(text.rlike("[0-9]"), digits)


def integer_key(text: Column) -> Column:
    """A product code as the canonical integer text both join sides use.

    Leading zeros go. Text that is not an integer (plain, with ``.0`` or in
    scientific notation) is NULL, so that its row counts as unmatched instead of
    stopping the load.
    """
    plain = F.regexp_replace(text, r"^0+(?=\d)|\.0$", "")
    return F.when(text.rlike(INTEGER), plain).when(text.rlike(SCIENTIFIC), _expanded(text))


def store_code(text: Column) -> Column:
    """Store id for output: leading zeros go when it is all digits, else kept as text."""
    return F.when(text.rlike(r"^\d+$"), without_leading_zeros(text)).otherwise(text)
