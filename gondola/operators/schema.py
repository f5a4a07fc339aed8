"""Headers, tolerant column lookup and layouts. Schema work only, no data pass."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from gondola.functions.text import known, plain_text, strip

# Where a feed row came from; together a total order over all rows read.
SOURCE_ORDER = ("source_file", "source_block", "source_row")

HEADER_STYLES = {
    "lower": lambda name: name.strip().lower(),
    "plain": lambda name: re.sub(r"\s+", " ", plain_text(name).lower()).strip(),
    "snake": lambda name: re.sub(r"\s+", "_", name.strip().lower()),
    "underscore": lambda name: name.strip().lower().replace(" ", "_"),
}


def normalize_headers(df: DataFrame, style: str) -> DataFrame:
    """Rename every column by one of ``HEADER_STYLES``; a stray byte-order mark goes too."""
    rule = HEADER_STYLES[style]
    return df.toDF(*[rule(name.lstrip("﻿")) for name in df.columns])


def column_key(name: str) -> str:
    return plain_text(name).strip().lower()


def resolve_columns(df: DataFrame, wanted: Iterable[str]) -> dict[str, str | None]:
    """For each wanted name the existing column that equals it but for case and accents."""
    existing = {column_key(name): name for name in df.columns}
    return {name: existing.get(column_key(name)) for name in wanted}


def column_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    found = resolve_columns(df, [name])[name]
    return F.lit(None).cast(dtype) if found is None else F.col(quoted(found))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise KeyError(f"{what} lacks required columns: {missing}")


def ensure_layout(
    df: DataFrame,
    layout: Sequence[str] | StructType,
    keep_extras: bool = False,
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exactly the layout's columns in its order; absent ones take a default or NULL.

    A ``StructType`` layout also fixes the types; ``keep_extras`` leaves the other
    columns at the end.
    """
    defaults = defaults or {}
    types = {f.name: f.dataType for f in layout} if isinstance(layout, StructType) else {}
    names = list(layout.names) if isinstance(layout, StructType) else list(layout)

    def one(name: str) -> Column:
        if name in df.columns:
            value = F.col(quoted(name))
        else:
            value = defaults.get(name, F.lit(None).cast("string"))
        return (value.try_cast(types[name]) if name in types else value).alias(name)

    extras = [F.col(quoted(c)) for c in df.columns if c not in names] if keep_extras else []
    return df.select(*[one(name) for name in names], *extras)


def put_first(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    first = [c for c in wanted if c in df.columns]
    return df.select(*[F.col(quoted(c)) for c in first + [c for c in df.columns if c not in first]])


def computed(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns that are evaluated once per row.

    After a plain ``select`` a filter on its columns, or the not-null test a join
    implies, moves below it and repeats their expressions, and parsed text costs far
    more to repeat than to filter late. Filters do not move below ``inline``.
    """
    kept = [F.col(quoted(c)) for c in df.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))


def clean_cells(df: DataFrame) -> DataFrame:
    """Every text cell stripped, missing markers as NULL."""
    return on_texts(strip_cells(df), known)


def strip_cells(df: DataFrame) -> DataFrame:
    return on_texts(df, strip)


def on_texts(df: DataFrame, function: Callable[[Column], Column]) -> DataFrame:
    """Apply a function to every text column but the row's source."""
    texts = {name for name, dtype in df.dtypes if dtype == "string" and name not in SOURCE_ORDER}
    return df.select(
        *[function(F.col(quoted(c))).alias(c) if c in texts else F.col(quoted(c)) for c in df.columns]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN as NULL in every floating-point column."""
    floats = {name for name, dtype in df.dtypes if dtype in ("double", "float")}
    return df.select(
        *[
            F.when(~F.isnan(quoted(c)), F.col(quoted(c))).alias(c) if c in floats else F.col(quoted(c))
            for c in df.columns
        ]
    )


def keep_enabled(df: DataFrame, enabled: Iterable[str], column: str = "category") -> DataFrame:
    return df.filter(F.col(column).isin(*enabled))


def drop_missing_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(quoted(key)).isNotNull() & (F.col(quoted(key)).cast("string") != ""))


def split_by_flag(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """(approved, pending) by a non-null boolean column."""
    return df.filter(F.col(flag)), df.filter(~F.col(flag))
