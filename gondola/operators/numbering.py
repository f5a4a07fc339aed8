"""Row numbers and running totals over data of any size and skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from gondola.operators.schema import SOURCE_ORDER, quoted
from gondola.session import written


def running_total(
    df: DataFrame,
    order_by: Sequence[str],
    group_by: Sequence[str] = (),
    weight: str | None = None,
    out: str = "index",
    stored: bool = False,
) -> DataFrame:
    """Number the rows 1..n per group in the given order, or sum ``weight`` so far.

    A window over the group would put a whole group into one task. Here the rows are
    range-partitioned by group and order, so that a large group covers many
    partitions, and written with their place in the partition. Every partition
    then contributes one subtotal per group, and the sum of the subtotals before it
    is what its own rows start from. ``order_by`` should be a total order; rows equal
    in all of it cannot be spread, so add a source position where copies may abound.

    Finding the ranges reads the rows once more. They are written first, unless they
    are ``stored``: read from a table with little work in between.
    """
    df = df if stored else written(df)
    keys = [quoted(c) for c in group_by]
    order = keys + [quoted(c) for c in order_by]
    place = {"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(place)
    placed = written(placed)

    amount = F.lit(1).cast("bigint") if weight is None else F.col(quoted(weight))
    parts = placed.groupBy(*keys, "_part").agg(
        F.sum(amount).alias("_sum"), F.min("_place").alias("_first")
    )
    # One row per partition and group, at most partitions + groups of them however large
    # the groups are. Written, so that Spark knows the size when it plans the join below.
    parts = written(parts)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *keys, "_part", "_first", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")
    )
    joined = _join_null_safe(placed, starts, list(group_by) + ["_part"])
    if weight is None:
        within = F.col("_place") - F.col("_first") + 1
    else:
        rows_so_far = (
            Window.partitionBy(*keys, "_part")
            .orderBy("_place")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        within = F.sum(amount).over(rows_so_far)
    names = [F.col(quoted(c)) for c in df.columns]
    return joined.select(*names, (F.col("_start") + within).alias(out))


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(quoted(key)).eqNullSafe(F.col(quoted(f"_r_{key}")))
    return left.join(renamed, condition, "inner").drop(*[f"_r_{k}" for k in keys])


#: Row ids of a file block that one task numbers.
BUCKET = 1 << 16


def file_order(df: DataFrame, group_by: Sequence[str] = (), out: str = "index", bucket: int = BUCKET) -> DataFrame:
    """Number the rows 1..n per group in the order in which their files hold them.

    No range sort. A block of a file is cut into buckets of ``bucket`` row ids, so no task
    numbers more rows than that however large a block is; a row's number is the count of rows in
    the blocks before, plus that in the buckets before in its block, plus its place in the
    bucket. The counts are one row per bucket. ``df`` should be stored, as it is read twice.
    """
    names = [quoted(c) for c in group_by]
    file, block, row = SOURCE_ORDER
    df = df.withColumn("_bucket", F.floor(F.col(row) / bucket))
    of_bucket = [*group_by, file, block, "_bucket"]
    counts = written(df.groupBy(*[quoted(c) for c in of_bucket]).agg(F.count(F.lit(1)).alias("_n")))
    blocks = counts.groupBy(*names, file, block).agg(F.sum("_n").alias("_n"))

    def before(*partition: str) -> WindowSpec:
        return Window.partitionBy(*partition).rowsBetween(Window.unboundedPreceding, -1)

    sum_before = lambda window: F.coalesce(F.sum("_n").over(window), F.lit(0))
    blocks = blocks.select(*names, file, block, sum_before(before(*names).orderBy(file, block)).alias("_blocks"))
    inside = counts.withColumn("_buckets", sum_before(before(*names, file, block).orderBy("_bucket")))
    starts = _join_null_safe(inside, blocks, [*group_by, file, block])
    starts = written(starts.select(*[quoted(c) for c in of_bucket], (F.col("_blocks") + F.col("_buckets")).alias("_start")))
    place = F.row_number().over(Window.partitionBy(*[quoted(c) for c in of_bucket]).orderBy(row))
    joined = _join_null_safe(df.withColumn("_place", place), starts, of_bucket)
    wanted = [F.col(quoted(c)) for c in df.columns if c != "_bucket"]
    return joined.select(*wanted, (F.col("_start") + F.col("_place")).alias(out))


def _numbered(
    df: DataFrame, order_by: Sequence[str], group_by: Sequence[str], out: str, stored: bool
) -> DataFrame:
    if tuple(order_by) == SOURCE_ORDER:
        return file_order(df if stored else written(df), group_by, out)
    return running_total(df, order_by, group_by, out=out, stored=stored)


def load_index(
    df: DataFrame, order_by: Sequence[str], group_by: Sequence[str], stored: bool = False
) -> DataFrame:
    """``index`` 1..n within each load (one category and period)."""
    return _numbered(df, order_by, group_by, "index", stored)


def run_row_ids(df: DataFrame, order_by: Sequence[str], run_stamp: str, stored: bool = False) -> DataFrame:
    """``Id`` = position in the run from 0, an underscore and the run's stamp."""
    numbered = _numbered(df, order_by, (), "_position", stored)
    ident = F.concat_ws("_", (F.col("_position") - 1).cast("string"), F.lit(run_stamp))
    return numbered.withColumn("Id", ident).drop("_position")
