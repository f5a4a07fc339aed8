"""Derivations specific to the two feeds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gondola.functions.dates import lookup
from gondola.functions.numbers import NUMBER
from gondola.functions.text import known

# Category words of drinks, and store types in order of priority.
DRINK_WORDS = ("BEBID", "CAÑ", "VINO", "CERVE")
STORE_TYPES = ("SUPERMERCADO", "TIENDA", "DESPENSA")

# Fixed value: the one store code that is corrected on arrival.
STORE_CODE_FIXES = {"360845043": "359545043"}


def presentation_text(content: Column, category: Column) -> Column:
    """Pack text from the stripped content: ``85 GR.``, or ``900 ML.`` for drinks.

    Missing content gives ``-``; content that is no number stays as it is.
    """
    number = F.translate(content, ",", ".")
    amount = F.when(number.rlike(NUMBER), number.try_cast("double"))
    whole = F.when(amount < 0, F.ceil(amount)).otherwise(F.floor(amount)).cast("string")
    name = F.upper(F.coalesce(category, F.lit("")))
    drink = F.lit(False)
    for word in DRINK_WORDS:
        drink = drink | name.contains(word)
    unit = F.when(drink, F.lit(" ML.")).otherwise(F.lit(" GR."))
    return (
        F.when(known(content).isNull(), F.lit("-"))
        .when(whole.isNotNull(), F.concat(whole, unit))
        .otherwise(content)
    )


def store_type(classification: Column) -> Column:
    """First store type named in the classification, else an empty text."""
    name = F.upper(classification)
    result = F.lit("")
    for kind in reversed(STORE_TYPES):
        result = F.when(name.contains(kind), F.lit(kind)).otherwise(result)
    return result


def fixed_store_code(code: Column) -> Column:
    return F.coalesce(lookup(code, STORE_CODE_FIXES), code)
