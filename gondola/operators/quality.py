"""Bad numbers, frequencies, profiles and run counters."""

from __future__ import annotations

import json
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gondola.functions.numbers import is_bad_number
from gondola.functions.text import strip
from gondola.operators.schema import quoted
from gondola.session import written


def bad_numbers(df: DataFrame, column: str, context: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``column`` is neither missing nor a number: the context and ``bad_value``."""
    shown = [F.col(quoted(c)) for c in context if c in df.columns]
    stripped = df.select(*shown, strip(F.col(quoted(column))).alias("bad_value"))
    return stripped.filter(is_bad_number(F.col("bad_value")))


def first_bad_number(
    df: DataFrame, column: str, context: Sequence[str], order_by: Sequence[str], where: Column | None = None
) -> Column:
    """Aggregate: the first row, in order, whose ``column`` is no number, as JSON of its context; NULL if none.

    Several of them can be taken in one pass, also while the rows are written.
    """
    value = strip(F.col(quoted(column)))
    bad = is_bad_number(value) & (F.lit(True) if where is None else where)
    shown = F.struct(*[F.col(quoted(c)) for c in context if c in df.columns and c != column], value.alias(column))
    place = F.struct(*[F.col(quoted(c)) for c in order_by])
    return F.min_by(F.to_json(shown, {"ignoreNullFields": "false"}), F.when(bad, place))


def bad_number_message(df: DataFrame, column: str, first: str, label: str = "") -> str:
    """What stops a strict run: the first bad row and, from one more pass, the commonest bad values."""
    bad = bad_numbers(df, column)
    common = [tuple(r) for r in top_values(bad, "bad_value").collect()]
    return f"{label} first value of {column!r} that is no number: {json.loads(first)}; commonest: {common}"


def require_numbers(
    df: DataFrame, column: str, context: Sequence[str], order_by: Sequence[str], label: str = ""
) -> None:
    """Fail on the first bad number in row order, showing it and the commonest ones."""
    first = df.agg(first_bad_number(df, column, context, order_by)).first()[0]
    if first is not None:
        raise ValueError(bad_number_message(df, column, first, label))


def frequencies(df: DataFrame, *columns: str) -> DataFrame:
    """How often each value occurs, NULL included."""
    return df.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The ``n`` commonest values; the value itself breaks ties."""
    counted = frequencies(df, column)
    return counted.orderBy(F.col("n").desc(), F.col(quoted(column))).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct()


#: Distinct values among which a rank is looked up in one window, and bins of a narrowing pass.
FEW, BINS = 1 << 16, 4096


def numeric_profile(df: DataFrame, column: str, group_by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, quartiles and max of a numeric column per group, as doubles.

    NULL and NaN do not count. The rows are read once, to count the distinct values; all the
    rest comes from those. The quartiles (linear between neighbours) are exact, by selection
    instead of sorting: histograms, which add up over tasks, narrow the place of each rank
    until it holds ``FEW`` values.
    """
    value = F.col(quoted(column)).cast("double")
    rows = df.filter(value.isNotNull() & ~F.isnan(value))
    # One group for the whole column; the column is stored below, so that matching on it
    # is a join by key like any other.
    rows = rows if group_by else rows.withColumn("_all", F.lit(0))
    shown = [quoted(c) for c in group_by]
    group_by = list(group_by) or ["_all"]
    keys = [quoted(c) for c in group_by]
    values = written(rows.select(*keys, value.alias("_v")).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    sums = values.groupBy(*keys).agg(
        F.sum("_c").alias("n"), (F.sum(F.col("_v") * F.col("_c")) / F.sum("_c")).alias("mean"),
        F.min("_v").alias("min"), F.max("_v").alias("max"), F.count(F.lit(1)).alias("_distinct"),
    )
    sums = written(sums)
    apart = F.col("_v") - F.col("mean")
    squares = _match(values, sums.select(*keys, "mean"), group_by).groupBy(*keys).agg(F.sum(apart * apart * F.col("_c")).alias("_squares"))
    moments = _match(sums, squares, group_by)
    std = F.when(F.col("n") > 1, F.sqrt(F.col("_squares") / (F.col("n") - 1)))
    quartiles = _quartiles(values, sums, group_by)
    return _match(moments, quartiles, group_by).select(*shown, "n", "mean", std.alias("std"), "min", "q25", "q50", "q75", "max")


def _quartiles(values: DataFrame, sums: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Per group q25, q50 and q75 of ``values`` (the group, _v, _c), of which ``sums`` has n, min, max and _distinct."""
    keys = [quoted(c) for c in group_by]
    # Position q*(n-1)/4, counted from 0, lies between the two neighbouring ranks _low and _high.
    ranks = sums.select(*keys, "n", "_distinct", F.col("min").alias("_from"), F.col("max").alias("_to"), F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("_q"))
    ranks = ranks.select(
        *keys, "_q", "_from", "_to", "_distinct", F.expr("(_q * (n - 1)) div 4").alias("_low"),
        F.expr("(_q * (n - 1) + 3) div 4").alias("_high"), (F.expr("(_q * (n - 1)) % 4") / 4.0).alias("_share"),
        F.lit(0).cast("bigint").alias("_before"),
    )
    ranks, curved = written(ranks), True
    while not ranks.filter(F.col("_distinct") > FEW).isEmpty():
        ranks, curved = _narrowed(values, ranks, group_by, curved), False
    inside = _inside(values, ranks, group_by)
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_q").orderBy("_v"))
    # A value covers the ranks [_upto - _c, _upto).
    holds = lambda rank: (F.col("_upto") - F.col("_c") <= F.col(rank)) & (F.col(rank) < F.col("_upto"))
    ends = inside.withColumn("_upto", upto).groupBy(*keys, "_q").agg(
        F.max(F.when(holds("_low"), F.col("_v"))).alias("_lo"), F.max(F.when(holds("_high"), F.col("_v"))).alias("_hi"),
        F.first("_share").alias("_share"),
    )
    between = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
        F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_share"))
    of = lambda q: F.max(F.when(F.col("_q") == q, between))
    return ends.groupBy(*keys).agg(of(1).alias("q25"), of(2).alias("q50"), of(3).alias("q75"))


def _inside(values: DataFrame, ranks: DataFrame, group_by: Sequence[str]) -> DataFrame:
    return _match(values, ranks, group_by).filter((F.col("_v") >= F.col("_from")) & (F.col("_v") <= F.col("_to")))


def _narrowed(values: DataFrame, ranks: DataFrame, group_by: Sequence[str], curved: bool) -> DataFrame:
    """``ranks`` with the range of values that still holds each cut down to its bins of a histogram.

    The first pass bins by a logarithm, which spreads values of any size; the next ones evenly
    between the least and the greatest value left, which always fall into different bins.
    """
    largest = F.lit(sys.float_info.max)
    finite = lambda name: F.least(F.greatest(F.col(name), -largest), largest)
    scale = (lambda name: F.signum(finite(name)) * F.log1p(F.abs(finite(name)))) if curved else finite
    keys = [*[quoted(c) for c in group_by], "_q"]
    wide = ranks.filter(F.col("_distinct") > FEW)
    share = F.try_divide(scale("_v") - scale("_from"), scale("_to") - scale("_from"))
    share = F.coalesce(share, F.when(F.col("_v") > F.col("_from"), 1.0).otherwise(0.0))
    binned = _inside(values, wide, group_by).withColumn("_bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)))
    state = ["_low", "_high", "_share", "_before"]
    bins = binned.groupBy(*keys, "_bin").agg(
        F.sum("_c").alias("_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to"), F.count(F.lit(1)).alias("_distinct"),
        F.max_by("_c", "_v").alias("_last"), *[F.first(c).alias(c) for c in state],
    )
    start = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bin")) - F.col("_n")
    kept = bins.withColumn("_start", start).filter((F.col("_start") <= F.col("_high")) & (F.col("_low") < F.col("_start") + F.col("_n")))
    # Both ranks in one bin, or the lower one the last of its bin and the upper one the first of the next.
    cut = kept.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in state[:-1]], F.count(F.lit(1)).alias("_bins"), F.sum("_distinct").alias("_distinct"),
        F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.min("_to").alias("_end"), F.max("_from").alias("_begin"),
        F.min("_start").alias("_before"), F.max("_start").alias("_next"), F.min_by("_last", "_bin").alias("_last"),
    )
    two = F.col("_bins") == 2
    cut = cut.select(
        *keys, *state[:-1], F.when(two, F.lit(2)).otherwise(F.col("_distinct")).cast("bigint").alias("_distinct"),
        F.when(two, F.col("_end")).otherwise(F.col("_from")).alias("_from"), F.when(two, F.col("_begin")).otherwise(F.col("_to")).alias("_to"),
        F.when(two, F.col("_next") - F.col("_last")).otherwise(F.col("_before")).alias("_before"),
    )
    return written(ranks.filter(F.col("_distinct") <= FEW).unionByName(cut.select(ranks.columns)))


def _match(left: DataFrame, right: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Bring the one row per group of ``right`` to the rows of ``left``."""
    renamed = right.withColumnsRenamed({c: f"_m_{c}" for c in group_by})
    condition = F.lit(True)
    for c in group_by:
        condition = condition & F.col(quoted(c)).eqNullSafe(F.col(quoted(f"_m_{c}")))
    return left.join(renamed, condition, "inner").drop(*[f"_m_{c}" for c in group_by])


def run_counters(tagged: DataFrame, product_key: str, store_key: str, group: str = "category") -> DataFrame:
    """Per group: rows in, rows matched at each step, and keys that go to review.

    Stores are checked on the rows whose product matched. The unmatched keys are
    grouped first (matched rows fall together under NULL), so counting distinct keys
    does not multiply the rows.
    """
    product_missed = ~F.col("has_product")
    store_missed = F.col("has_product") & ~F.col("has_store")
    by_key = tagged.groupBy(
        quoted(group),
        product_missed.alias("_pm"),
        store_missed.alias("_sm"),
        F.when(product_missed, F.col(quoted(product_key))).alias("_pk"),
        F.when(store_missed, F.col(quoted(store_key))).alias("_sk"),
    ).agg(F.count(F.lit(1)).alias("_n"))
    rows = F.col("_n")
    return by_key.groupBy(quoted(group)).agg(
        F.sum(rows).alias("rows_in"),
        F.sum(F.when(F.col("_pm"), 0).otherwise(rows)).alias("product_matched"),
        F.sum(F.when(F.col("_pm") | F.col("_sm"), 0).otherwise(rows)).alias("store_matched"),
        F.count_if(F.col("_pm")).alias("product_keys_unmatched"),
        F.count_if(F.col("_sm")).alias("store_keys_unmatched"),
    )


def remap_count(remapped: DataFrame) -> DataFrame:
    """How many rows a store id remap changed."""
    return remapped.agg(F.count_if("remapped").alias("remapped_rows"), F.count(F.lit(1)).alias("rows"))
