"""The only place that writes. ``dry_run`` computes nothing and writes nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gondola.functions.dates import period
from gondola.operators.schema import quoted


def write_month(fact: DataFrame, path: str, category: str, month: str, dry_run: bool = False) -> None:
    """Put ``fact`` in place of one category and month (``yyyy-MM``).

    Overwrites that one partition folder, so an empty batch empties the month.
    """
    if not dry_run:
        fact.drop("category", "period").write.mode("overwrite").parquet(
            f"{path}/category={category}/period={month}"
        )


def write_periods_found(
    fact: DataFrame, path: str, date_column: str, partition_by: Sequence[str] = ("period",), dry_run: bool = False
) -> None:
    """Replace the partitions that occur in ``fact`` and leave all others alone.

    One shuffle first brings the rows of a partition together, so that each of them
    gets few files; AQE splits a partition too large for one task.
    """
    if dry_run:
        return
    dated = fact.withColumn("period", period(F.col(quoted(date_column))))
    (
        dated.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_queue(queue: DataFrame, path: str, dry_run: bool = False) -> None:
    """Replace a review queue. The path must not be one the queue is read from."""
    if not dry_run:
        queue.write.mode("overwrite").parquet(path)


def append_dimension(rows: DataFrame, path: str, dry_run: bool = False) -> None:
    if not dry_run:
        rows.write.mode("append").parquet(path)


def write_rejects(rejects: DataFrame, path: str, dry_run: bool = False) -> None:
    """One folder per reason."""
    if not dry_run:
        rejects.write.mode("overwrite").partitionBy("reason").parquet(path)
