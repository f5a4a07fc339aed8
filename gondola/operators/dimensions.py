"""Dimensions built from a feed, and insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gondola.functions.numbers import whole_number
from gondola.functions.text import strip
from gondola.operators.dedup import keep_first
from gondola.operators.joins import anti_by_key
from gondola.operators.schema import drop_missing_key, quoted

# Feed column -> dimension column, panel feed.
PANEL_PRODUCT_COLUMNS = {
    "codigo barras sku": "Id_Producto",
    "categoria sku": "Categoria_SKU",
    "cant contenido sku": "Cant_Contenido_SKU",
    "escencia": "Escencia",
    "sabor": "Sabor",
}
PANEL_STORE_COLUMNS = {
    "codigo unico pdv": "Id_Comercial",
    "nombre pdv": "Nombre_PDV",
    "estado pdv": "Estado_PDV",
    "localidad pdv": "Localidad_PDV",
    "direccion pdv": "Direccion_PDV",
    "pdv ruc": "RUC_PDV",
    "pdv_razon_social": "Razon_Social_PDV",
    "pdv razon social": "Razon_Social_PDV",
    "pdv clasif 3": "Pdv_Clasif_3",
    "tipo_de_comercio": "Tipo_de_Comercio",
}


def product_dimension(feed: DataFrame) -> DataFrame:
    """Distinct products of a panel feed, with whatever ``prod clasif`` columns it has."""
    columns = {c: new for c, new in PANEL_PRODUCT_COLUMNS.items() if c in feed.columns}
    columns |= {c: c for c in feed.columns if c.startswith("prod clasif ")}
    dim = feed.select(*[F.col(quoted(c)).alias(new) for c, new in columns.items()])
    dim = drop_missing_key(dim, "Id_Producto").distinct()
    if "Cant_Contenido_SKU" not in dim.columns:
        return dim
    stripped = dim.withColumn("Cant_Contenido_SKU", strip(F.col("Cant_Contenido_SKU")))
    return stripped.withColumn("Cant_Contenido_SKU", whole_number(F.col("Cant_Contenido_SKU")))


def store_dimension(feed: DataFrame) -> DataFrame:
    """Distinct stores of a panel feed."""
    columns: dict[str, str] = {}
    for ours, theirs in PANEL_STORE_COLUMNS.items():
        if ours in feed.columns:
            columns.setdefault(theirs, ours)
    dim = feed.select(*[F.col(quoted(c)).alias(new) for new, c in columns.items()])
    return drop_missing_key(dim, "Id_Comercial").distinct()


def absent_rows(
    new: DataFrame, existing: DataFrame | None, key: str, order_by: Sequence[str] = ()
) -> DataFrame:
    """One row per key of ``new`` that the table does not have yet. Nothing is updated."""
    fresh = new if existing is None else anti_by_key(new, existing, key, key)
    return keep_first(fresh, [key], order_by)


def insert_if_absent(
    existing: DataFrame | None, new: DataFrame, key: str, order_by: Sequence[str] = ()
) -> DataFrame:
    """The table after inserting; without a table all of ``new`` is inserted."""
    fresh = absent_rows(new, existing, key, order_by)
    return fresh if existing is None else existing.unionByName(fresh, allowMissingColumns=True)
