"""Dimension, queue and mapping tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from gondola.operators.dedup import keep_last
from gondola.operators.schema import clean_cells, normalize_headers, quoted, require_columns


def read_dimension(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """A dimension table, all columns or only those named (pruned in the scan)."""
    table = spark.read.parquet(path)
    return table.select(*[quoted(c) for c in columns]) if columns else table


def read_chain_products(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, ["ean", "gramaje", "presentacion"])


def read_chain_stores(spark: SparkSession, path: str) -> DataFrame:
    return read_dimension(spark, path, ["id_sucursal_bg"])


def existing_keys(table: DataFrame, key: str) -> DataFrame:
    return table.select(quoted(key))


def read_queue(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """A review queue; from CSV every column, the flag included, is text."""
    if file_format == "csv":
        return spark.read.option("header", True).option("escape", '"').csv(path)
    return spark.read.format(file_format).load(path)


def store_id_mapping(raw: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """New store id -> historical id and name: rows with both ids, the last one per new id.

    ``order_by`` says which row is the last; by default the row's own columns do.
    """
    named = normalize_headers(raw, "underscore")
    order = [c.strip().lower().replace(" ", "_") for c in order_by]
    require_columns(named, ["id_sucursal_nuevo", "id_sucursal_viejo"], "store id mapping")
    if "nombre" not in named.columns:
        named = named.withColumn("nombre", F.lit(None).cast("string"))
    wanted = ["id_sucursal_nuevo", "id_sucursal_viejo", "nombre"]
    cleaned = named.withColumns({c: F.col(c).cast("string") for c in wanted})
    cleaned = clean_cells(cleaned)
    both = cleaned.filter(F.col("id_sucursal_nuevo").isNotNull() & F.col("id_sucursal_viejo").isNotNull())
    return keep_last(both, ["id_sucursal_nuevo"], order or wanted).select(*wanted)


def read_store_names(spark: SparkSession, path: str) -> DataFrame | None:
    """The store name corrections (a JSON list of records), or None when unusable."""
    try:
        raw = spark.read.option("multiLine", True).json(path)
    except AnalysisException:
        return None
    return store_name_mapping(raw)


def store_name_mapping(raw: DataFrame) -> DataFrame | None:
    if not {"Nombre PDV", "Nombre PDV Correcto"} <= set(raw.columns):
        return None
    known = [c for c in ("Nombre PDV", "PDV_RAZON_SOCIAL", "Nombre PDV Correcto") if c in raw.columns]
    texts = raw.select(*[F.col(quoted(c)).cast("string").alias(c) for c in known])
    return clean_cells(texts).filter(F.col("`Nombre PDV`").isNotNull())
