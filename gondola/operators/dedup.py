"""Keep-first, distinct keys and distinct periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gondola.functions.dates import month_start
from gondola.operators.schema import quoted


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(quoted(n)) if isinstance(n, str) else n for n in names]


def keep_first(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """The first row per key under an explicit order, NULL being a key of its own.

    Without ``order_by`` all columns decide, so ties are identical rows. Spark cuts
    each key to one row per input partition before the shuffle (WindowGroupLimit),
    so a key that holds most of the rows costs no more than any other.
    """
    order = _columns(order_by or df.columns)
    ranked = Window.partitionBy(*_columns(keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def first_row(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """``keep_first`` as an aggregate: the smallest row per key, NULL being a key of its own.

    Spark knows that an aggregate is unique on its keys, and computes only the columns that are
    used. So a left join with it is left out where nothing reads its columns, and counting the rows
    shuffles the keys alone. Rows equal in ``order_by`` are told apart by the other columns, which
    must be of types that have an order.
    """
    order = list(dict.fromkeys(order_by or df.columns))
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(quoted(c)) for c in dict.fromkeys([*order, *rest]) if c not in keys])
    if not rest:
        return distinct_keys(df, *keys)
    first = df.groupBy(*_columns(keys)).agg(F.min(row).alias("_first"))
    fields = {c: F.col("_first").getField(c).alias(c) for c in rest}
    return first.select(*[fields.get(c, F.col(quoted(c))) for c in df.columns])


def keep_last(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str]) -> DataFrame:
    return keep_first(df, keys, [F.col(quoted(c)).desc() for c in order_by])


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*_columns(keys)).distinct()


def distinct_periods(df: DataFrame, date_column: str) -> DataFrame:
    """First days of the months that occur, rows without a date aside."""
    day = F.col(quoted(date_column))
    return df.filter(day.isNotNull()).select(month_start(day).alias("period")).distinct()
