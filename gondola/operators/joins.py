"""Fact-dimension joins, key checks and value mappings.

No broadcast hints: Spark broadcasts a side whose size it knows to be under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise. All joins here
keep the large side on the left of an inner, left or anti join, the shapes in
which Spark can split a hot key of a shuffled join (see ``session.RUNTIME_CONF``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    DataType, DecimalType, DoubleType, FloatType, IntegralType, LongType, NumericType, StringType,
)

from gondola.functions.text import match_key, strip
from gondola.operators.dedup import distinct_keys, first_row, keep_first
from gondola.operators.schema import quoted, require_columns

HOW = ("inner", "left", "right", "outer")


def number_form(value: Column, kind: DataType) -> Column:
    """A number's sign, digits and exponent as text: equal for equal numbers of any type or spelling.

    Nothing is rounded. Text counts without white space around it, in plain or scientific
    notation; what is no number, or has an exponent beyond 18 digits, is NULL. A whole
    floating-point number stands for its exact value (up to 2^124), any other for the
    shortest decimal that names it, as it is shown. Zeros have no sign. NaN and infinities
    equal themselves only.
    """
    text = strip(value.cast("string"))
    if isinstance(kind, (FloatType, DoubleType)):
        # Halves of 62 bits, as casting a double to a decimal goes by its shortest digits.
        size, step = F.abs(value.cast("double")), float(1 << 62)
        high = F.floor(size / step)
        low = (size - high.cast("double") * step).try_cast("bigint")
        exact = high.cast(DecimalType(38, 0)) * F.lit(1 << 62).cast(DecimalType(19, 0)) + low.cast(DecimalType(19, 0))
        exact = F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), exact.cast("string"))
        text = F.when((size < F.lit(float(1 << 124))) & (F.rint(size) == size), exact).otherwise(text)
    parts = F.regexp_extract(text, NUMBER, 1), F.regexp_extract(text, NUMBER, 2), F.regexp_extract(text, NUMBER, 3)
    digits = F.ltrim(F.replace(parts[1], F.lit("."), F.lit("")), F.lit("0"))
    decimals = F.when(parts[1].contains("."), F.length(parts[1]) - F.instr(parts[1], ".")).otherwise(0)
    exponent = F.when(parts[2] == "", F.lit(0).cast("bigint")).otherwise(parts[2].try_cast("bigint"))
    significant = F.rtrim(digits, F.lit("0"))
    exponent = exponent - decimals + F.length(digits) - F.length(significant)
    sign = F.when(parts[0] == "-", F.lit("-")).otherwise(F.lit(""))
    form = F.when(significant == "", F.lit("0")).otherwise(F.concat(sign, significant, F.lit("e"), exponent.cast("string")))
    other = F.lit(None).cast("string")
    if isinstance(kind, (FloatType, DoubleType)):
        other = F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), text)
    return F.when(text.rlike(NUMBER), form).otherwise(other)


#: Sign, digits with or without a point, exponent.
NUMBER = r"^([+-]?)([0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE]([+-]?[0-9]{1,18}))?$"


def _compared(left: DataType, right: DataType) -> Callable[[Column, DataType], Column]:
    """How the keys of two types become comparable.

    Of one type as they are, whole numbers as longs, floating-point numbers as doubles; all
    other numbers, and numbers with text, by ``number_form``, as no common type holds all of both.
    """
    if left == right:
        return lambda key, _: key
    types = (left, right)
    if all(isinstance(t, IntegralType) for t in types):
        return lambda key, _: key.cast(LongType())
    if all(isinstance(t, (FloatType, DoubleType)) for t in types):
        return lambda key, _: key.cast(DoubleType())
    if not all(isinstance(t, (NumericType, StringType)) for t in types):
        raise ValueError(f"keys of types {left.simpleString()} and {right.simpleString()} do not compare")
    return number_form


def _same(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> Column:
    """Equal keys, written so that a hot key can be split.

    Keys of two types are compared by their exact value (see ``_compared``): a key equals
    another if both name the same number. Text that is no number equals no number. Text
    with text is compared as text. Types that are neither raise.

    The dimension side was just made unique, so it lies partitioned by its key. Spark
    would join it in place, and then it cannot divide the other side's hot partitions.
    The second test follows from the first but makes both sides shuffle for the join
    (only where nothing is broadcast).
    """
    types = [df.select(F.col(quoted(k))).schema[0].dataType for df, k in ((left, left_key), (right, right_key))]
    comparable = _compared(*types)
    a, b = comparable(F.col(quoted(left_key)), types[0]), comparable(F.col(quoted(right_key)), types[1])
    if all(isinstance(t, (FloatType, DoubleType)) for t in types):
        a, b = a + 0.0, b + 0.0  # 0 and -0 are equal but spelled differently
    return (a == b) & (F.octet_length(a.cast("string")) == F.octet_length(b.cast("string")))


def _prepared_dimension(fact: DataFrame, dim: DataFrame, dedup_on: str | None) -> DataFrame:
    if dedup_on is not None:
        dim = keep_first(dim, [dedup_on])
    clashes = {c: c + "_dim" for c in dim.columns if c in fact.columns}
    return dim.withColumnsRenamed(clashes)


def validated_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    how: str = "inner",
    dedup_dim: bool = True,
    indicator: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(joined, unmatched): the join by ``how``, and fact rows without a dimension row.

    A dimension column that also exists in the fact gets the suffix ``_dim``.
    ``unmatched`` has one row per key and does not depend on ``how``.
    ``indicator`` names a column telling ``both``, ``left_only`` or ``right_only``.
    """
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}, not {how!r}")
    require_columns(fact, [fact_key], "fact")
    require_columns(dim, [dim_key], "dimension")
    right = _prepared_dimension(fact, dim, dim_key if dedup_dim else None)
    right_key = dim_key if dim_key in right.columns else dim_key + "_dim"
    return (
        _joined(fact, right, fact_key, right_key, how, indicator),
        unmatched_rows(fact, dim, fact_key, dim_key),
    )


def _joined(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str, indicator: str | None
) -> DataFrame:
    seen = dim.withColumn("_seen", F.lit(True))
    condition = _same(fact, fact_key, seen, dim_key)
    side = F.when(F.col("_seen"), F.lit("both")).otherwise(F.lit("left_only"))
    joined = fact.join(seen, condition, "left" if how in ("left", "outer") else "inner")
    joined = joined.withColumn(indicator, side) if indicator else joined
    joined = joined.drop("_seen")
    if how in ("inner", "left"):
        return joined
    # Dimension rows no fact row uses. Done apart from the join itself, because a
    # right or full outer join can neither broadcast the dimension nor split a hot
    # fact key; the distinct keys are combined before they are shuffled.
    used = distinct_keys(fact, fact_key).withColumnRenamed(fact_key, "_used")
    unused = dim.join(used, _same(dim, dim_key, used, "_used"), "left_anti")
    unused = unused.withColumn(indicator, F.lit("right_only")) if indicator else unused
    return joined.unionByName(unused, allowMissingColumns=True)


def unmatched_rows(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Fact rows whose key the dimension lacks, the first row per key."""
    return keep_first(anti_by_key(fact, dim, fact_key, dim_key), [fact_key], order_by)


def anti_by_key(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """All fact rows whose key the dimension lacks; rows without a key are kept."""
    known = distinct_keys(dim, dim_key).withColumnRenamed(dim_key, "_known")
    return fact.join(known, _same(fact, fact_key, known, "_known"), "left_anti")


def with_key_flag(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, flag: str, dedup: bool = True
) -> DataFrame:
    """Mark every row by whether the dimension has its key, adding the dimension's
    other columns. The dimension must be unique on the key unless ``dedup`` is set."""
    dim = keep_first(dim, [dim_key]) if dedup else dim
    known = dim.withColumnRenamed(dim_key, "_known")
    joined = df.join(known, _same(df, key, known, "_known"), "left")
    return joined.withColumn(flag, F.col("_known").isNotNull()).drop("_known")


def key_flags(
    df: DataFrame, stores: DataFrame, products: DataFrame, store_key: str, product_key: str
) -> DataFrame:
    """Every row with ``has_product`` and ``has_store``, checked independently.

    A key column absent on either side counts as found.
    """
    for dim, key, flag in ((products, product_key, "has_product"), (stores, store_key, "has_store")):
        if key in df.columns and key in dim.columns:
            df = with_key_flag(df, distinct_keys(dim, key), key, key, flag, dedup=False)
        else:
            df = df.withColumn(flag, F.lit(True))
    return df


def split_valid(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ok without the flags, bad with them)."""
    ok = F.col("has_product") & F.col("has_store")
    return flagged.filter(ok).drop("has_product", "has_store"), flagged.filter(~ok)


def provenance(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """The full outer join with ``origin``: both, left_only or right_only."""
    return validated_join(fact, dim, fact_key, dim_key, "outer", indicator="origin")[0]


def remap_store_ids(
    df: DataFrame, mapping: DataFrame, id_column: str = "id_sucursal", name_column: str | None = None
) -> DataFrame:
    """Replace new store ids by historical ones, and the store name where there is one.

    ``mapping`` (see ``sources.mappings.store_id_mapping``) is unique on
    ``id_sucursal_nuevo``. Both values are looked up by the id as it came.
    ``remapped`` tells which rows changed.
    """
    stripped = df.withColumn(id_column, strip(F.col(quoted(id_column))))
    renamed = mapping.select(
        F.col("id_sucursal_nuevo").alias("_new"),
        F.col("id_sucursal_viejo").alias("_old"),
        F.col("nombre").alias("_name"),
    )
    joined = stripped.join(renamed, _same(stripped, id_column, renamed, "_new"), "left")
    changed = {"remapped": F.col("_new").isNotNull(), id_column: F.coalesce("_old", F.col(quoted(id_column)))}
    if name_column:
        changed[name_column] = F.coalesce("_name", F.col(quoted(name_column)))
    return joined.withColumns(changed).drop("_new", "_old", "_name")


def correct_store_names(
    df: DataFrame,
    mapping: DataFrame | None,
    name_column: str = "nombre pdv",
    legal_column: str = "pdv_razon_social",
) -> DataFrame:
    """Store names replaced by their corrected form.

    Compares stripped and upper-cased; by name and legal name when both sides have
    the latter, else by name. Without a usable mapping the rows pass unchanged.
    """
    if mapping is None or name_column not in df.columns:
        return df
    keys = {name_column: "Nombre PDV"}
    if legal_column in df.columns and "PDV_RAZON_SOCIAL" in mapping.columns:
        keys[legal_column] = "PDV_RAZON_SOCIAL"
    fixes = mapping.select(
        *[match_key(F.col(quoted(theirs))).alias(f"_k{i}") for i, theirs in enumerate(keys.values())],
        F.col("`Nombre PDV Correcto`").alias("_fixed"),
    )
    key_names = [f"_k{i}" for i in range(len(keys))]
    fixes = first_row(fixes.dropna(), key_names)
    fixes = fixes.withColumnsRenamed({k: "_m" + k for k in key_names})
    keyed = df.withColumns(
        {f"_k{i}": match_key(F.col(quoted(ours))) for i, ours in enumerate(keys)}
    )
    condition = reduce(and_, [_same(keyed, k, fixes, "_m" + k) for k in key_names])
    joined = keyed.join(fixes, condition, "left")
    fixed = strip(F.coalesce("_fixed", F.col(quoted(name_column))))
    return joined.withColumn(name_column, fixed).select(*[F.col(quoted(c)) for c in df.columns])
