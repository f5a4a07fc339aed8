"""Tables after a load: the month, or the months found, replaced."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from gondola.functions.dates import month_start
from gondola.operators.dedup import distinct_periods
from gondola.operators.schema import quoted


def month_bounds(day: datetime.date) -> tuple[datetime.date, datetime.date]:
    start = day.replace(day=1)
    return start, (start + datetime.timedelta(days=32)).replace(day=1)


def replace_month(
    existing: DataFrame, new: DataFrame, start: datetime.date, end: datetime.date, date_column: str = "fecha"
) -> DataFrame:
    """The table with ``[start, end)`` taken out and ``new`` put in.

    Rows without a date stay, as they do under SQL DELETE.
    """
    day = F.col(quoted(date_column))
    gone = F.coalesce((day >= F.lit(start)) & (day < F.lit(end)), F.lit(False))
    return existing.filter(~gone).unionByName(new)


def replace_periods_found(existing: DataFrame, new: DataFrame, date_column: str = "Fecha") -> DataFrame:
    """The table with every month that occurs in ``new`` replaced by ``new``."""
    # Months are bounded by the calendar, so this side always fits in a broadcast.
    months = F.broadcast(distinct_periods(new, date_column))
    kept = existing.join(months, month_start(F.col(quoted(date_column))) == F.col("period"), "left_anti")
    return kept.unionByName(new)


def rejects_by_reason(bad: DataFrame, reasons: dict[str, str]) -> DataFrame:
    """Rejected rows with ``reason``, a row once for each reason it has.

    ``reasons`` maps a boolean column that marks a failure (true = failed) to the
    reason's name; a row none of them explains gets ``other``.
    """
    named = F.array_compact(
        F.array(*[F.when(F.col(quoted(c)), F.lit(name)) for c, name in reasons.items()])
    )
    listed = F.when(F.size(named) > 0, named).otherwise(F.array(F.lit("other")))
    return bad.withColumn("reason", F.explode(listed))
