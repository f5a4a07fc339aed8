"""The approval flag of the review queues."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType

from gondola.functions.text import SPACE_CLASS, strip

# Accepted spellings.
LENIENT_TRUE = ("true", "1", "yes", "y", "si", "sí", "x", "t", "verdadero")
LENIENT_FALSE = ("false", "0", "no", "n", "f", "falso")
STRICT_TRUE = ("true", "1", "si", "sí", "yes", "verdadero")


def approved(flag: Column, dtype: DataType, mode: str = "lenient") -> Column:
    """The flag as a non-null boolean.

    Missing is false. Numbers: ``lenient`` cuts the fraction first, so 0.5 is
    false; ``strict`` takes any non-zero number. Text: a word list per mode;
    ``lenient`` ignores white space anywhere and falls back to "contains true".
    """
    if mode not in ("lenient", "strict"):
        raise ValueError(f"mode must be 'lenient' or 'strict', not {mode!r}")
    if isinstance(dtype, BooleanType):
        result = flag
    elif isinstance(dtype, NumericType):
        value = flag.cast("double")
        usable = ~F.isnan(value)
        result = usable & ((F.abs(value) >= 1) if mode == "lenient" else (value != 0))
    elif mode == "strict":
        result = F.lower(strip(flag)).isin(*STRICT_TRUE)
    else:
        word = F.lower(F.regexp_replace(flag, SPACE_CLASS + "+", ""))
        result = (
            F.when(word.isin(*LENIENT_TRUE), True)
            .when(word.isin(*LENIENT_FALSE), False)
            .otherwise(word.contains("true") | word.contains("verdadero"))
        )
    return F.coalesce(result, F.lit(False))


def find_flag_column(columns: list[str], flag: str) -> str | None:
    """The column that carries the flag: by name, else one containing all its words."""
    by_name = {c.lower().replace(" ", "_"): c for c in columns}
    if flag in by_name:
        return by_name[flag]
    words = flag.split("_")
    return next((c for c in columns if all(w in c.lower() for w in words)), None)
