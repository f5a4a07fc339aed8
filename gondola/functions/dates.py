"""Dates, months and the periods named in file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gondola.functions.text import strip

# Spanish month names in calendar order, and the alternative spelling.
MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
MONTH_ALIASES = {"Setiembre": 9}

MONTH_NUMBERS = {name.upper(): i for i, name in enumerate(MONTHS, start=1)} | {
    name.upper(): i for name, i in MONTH_ALIASES.items()
}
ANY_MONTH = "|".join(name.lower() for name in MONTH_NUMBERS)


def lookup(key: Column, pairs: dict[str, str]) -> Column:
    """Value of a fixed small mapping, NULL when absent."""
    entries = [F.lit(part) for pair in pairs.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), key)


def month_number(text: Column) -> Column:
    """Month name to its number as text; anything else passes through."""
    numbers = {name: str(number) for name, number in MONTH_NUMBERS.items()}
    return F.coalesce(lookup(F.upper(strip(text)), numbers), text)


def month_name(day: Column) -> Column:
    # try_element_at: under ANSI, element_at takes a NULL index for a value.
    return F.try_element_at(F.array(*[F.lit(name) for name in MONTHS]), F.month(day))


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def next_month_start(day: Column) -> Column:
    return F.add_months(F.trunc(day, "month"), 1)


def previous_month_start(day: Column) -> Column:
    return F.add_months(F.trunc(day, "month"), -1)


def target_day(day: Column) -> Column:
    """The day a chain run works for: on day 1 still the last day of the month before."""
    return F.when(F.day(day) == 1, F.date_sub(day, 1)).otherwise(day)


def period(day: Column) -> Column:
    """Partition value ``yyyy-MM``."""
    return F.date_format(day, "yyyy-MM")


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from three texts; NULL when they name no calendar day."""
    def number(part: Column) -> Column:
        return strip(part).try_cast("int")

    return F.try_make_timestamp(
        number(year), number(month), number(day), F.lit(0), F.lit(0), F.lit(0)
    ).cast("date")


def day_month_year(text: Column) -> Column:
    """Date from stripped ``dd/mm/yyyy``; NULL on any other shape or an impossible day."""
    iso = F.concat_ws(
        "-",
        F.substring_index(text, "/", -1),
        F.substring_index(F.substring_index(text, "/", 2), "/", -1),
        F.substring_index(text, "/", 1),
    )
    return F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), iso.try_cast("date"))


def day_month_year_strict(text: Column) -> Column:
    """Date from stripped ``dd/mm/yyyy``; the job fails on a value that is not one."""
    wrong = F.raise_error(F.concat(F.lit("not a dd/mm/yyyy date: "), text)).cast("date")
    return F.when(text.isNotNull(), F.coalesce(day_month_year(text), wrong))


def reparsed_date(value: Column) -> Column:
    """ISO date text, or a date, as a date; NULL when it is not one."""
    return F.try_to_date(strip(value.cast("string")), "yyyy-MM-dd")
