"""What the operators share: tables, text batches, stored intermediate tables, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gondola.session import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decoded(values: pa.Array) -> list[str]:
    """Texts of a binary Arrow array; NULL is empty, bytes that are no UTF-8 become U+FFFD."""
    return ["" if v is None else v.decode("utf-8", "replace") for v in values.to_pylist()]


def per_text(function: Callable[[], Callable[[list[str]], pa.Array]], returns: str, text: Column, rows: int | None = None) -> Column:
    """Apply ``function()``, made once per task, to the texts of a column, batch by batch.

    Texts cross to Python as Arrow batches and are handled one by one, so a task holds one
    batch; with ``rows`` given, only so many of its texts are decoded at once. The result column
    never depends on other rows.
    """

    @F.arrow_udf(returns)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = function()
        for batch in batches:
            step = rows or max(1, len(batch))
            yield pa.concat_arrays([run(decoded(batch.slice(i, step))) for i in range(0, max(1, len(batch)), step)])

    return apply(text.cast("string").cast("binary"))


def struct_array(**fields: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays(list(fields.values()), names=list(fields))


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component): each node of an edge with the smallest node it is connected to.

    Distributed union-find by alternating steps: first each node's larger neighbours are
    linked to its smallest neighbour, then its smaller ones. Trees become stars in a
    logarithmic number of rounds. Every round is written to the shared folder; smallest
    neighbours are combined before they are shuffled, and joined from a written table, so a
    node with very many links is split among tasks. Self links and NULLs add nothing; no
    edges give no rows.
    """
    links = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u <> v")
    links = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (state := _state(links)) != before:
        before = state
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct())
        smallest = written(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(smallest.select("u", F.col("m").alias("v")))
        links = written(small.distinct())
    stars = links.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return written(stars.unionByName(roots))


def _state(links: DataFrame) -> tuple:
    """Number and checksum of the links: equal when a round changed nothing."""
    mixed = F.xxhash64("u", "v")
    return tuple(links.agg(F.count("*"), F.sum(F.shiftright(mixed, 24)), F.bit_xor(mixed)).first())
