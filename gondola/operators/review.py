"""Review queues: what could not be matched, laid out like the dimension it is for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gondola.functions.numbers import thousands_number
from gondola.functions.retail import presentation_text
from gondola.functions.text import strip
from gondola.operators.dedup import first_row, keep_first
from gondola.operators.joins import anti_by_key
from gondola.operators.schema import column_or_null, quoted, require_columns

FLAG = "para_escritura"

# Feed column -> dimension column, chain feed.
CHAIN_PRODUCT_COLUMNS = {
    "descripcion": "producto",
    "proveedor": "proveedor",
    "marca": "marca",
    "clasificacion": "clasificacion",
    "codigo de barras": "ean",
    "gramaje": "gramaje",
}
CHAIN_STORE_COLUMNS = {"id_sucursal": "id_sucursal_bg", "sucursal": "nombre_local"}

# Dimension column -> feed column, panel feed.
PANEL_PRODUCT_SOURCES = {
    "Id_Producto": "codigo barras sku",
    "Descripcion_del_Producto": "nombre sku",
    "Marca": "marca sku",
    "Categoria": "categoria sku",
    "Segmento": "prod clasif 3",
    "Sub_Segmento": "prod clasif 4",
    "Variedades": "prod clasif 5",
    "Proveedor": "proveedor sku",
    "especialidad": "prod clasif 6",
    "Empaque": "prod clasif 10",
    "clasificacion": "prod clasif 7",
}
PANEL_PRODUCT_DEFAULTS = {"talle": "-", "unidades": 0, "es_promo": "NO"}
PANEL_STORE_QUEUE = (
    "Código único PDV", "Pdv Clasif 3", "Pdv RUC", "PDV_RAZON_SOCIAL",
    "Nombre PDV", "Estado PDV", "Localidad PDV", "Dirección PDV",
)


def _laid_out(values: Mapping[str, Column], layout: Sequence[str]) -> list[Column]:
    return [values.get(c, F.lit(None).cast("string")).alias(c) for c in layout]


def chain_product_queue(
    unmatched: DataFrame, layout: Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """Chain rows without a product, one per product code, in the product layout.

    ``unmatched`` covers all categories (column ``category``, which also replaces the
    feed's own category text); ``layout`` is the column list of the dimension table.
    By default the columns of the queue decide which row of a code comes first, the
    category's rank (``category_rank``) before them.
    """
    values = {
        new: column_or_null(unmatched, old) for old, new in CHAIN_PRODUCT_COLUMNS.items()
    } | {"categoria": F.upper("category")}
    return _queue(unmatched, values, layout, "ean", order_by)


def chain_store_queue(
    unmatched: DataFrame, layout: Sequence[str], order_by: Sequence[str | Column] = ()
) -> DataFrame:
    """Chain rows without a store, one per store id, in the store layout."""
    values = {new: column_or_null(unmatched, old) for old, new in CHAIN_STORE_COLUMNS.items()}
    return _queue(unmatched, values, layout, "id_sucursal_bg", order_by)


def _queue(
    unmatched: DataFrame,
    values: Mapping[str, Column],
    layout: Sequence[str],
    key: str,
    order_by: Sequence[str | Column],
) -> DataFrame:
    order = [F.col(quoted(c)) if isinstance(c, str) else c for c in order_by]
    if not order:
        rank = [F.col("category_rank")] if "category_rank" in unmatched.columns else []
        order = rank + [values[c] for c in layout if c in values]
    ordering = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    rows = unmatched.select(*_laid_out(values, layout), ordering.alias("_order"))
    return keep_first(rows, [key], ["_order"]).drop("_order").withColumn(FLAG, F.lit(False))


def panel_product_queue(
    feed: DataFrame,
    dim: DataFrame,
    layout: Sequence[str],
    constants: Mapping[str, object] | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Panel products the dimension lacks: the flag, then the dimension's columns.

    ``layout`` is the dimension's column list. ``constants`` adds values for columns
    the feed has nothing for, such as the marker of own or other brands.
    """
    require_columns(feed, ["codigo barras sku"], "panel feed")
    rows = _first_missing(feed, dim, "codigo barras sku", "Id_Producto", order_by)
    has_content = "cant contenido sku" in rows.columns
    rows = rows.withColumn("_content", strip(column_or_null(rows, "cant contenido sku")))
    content = F.col("_content")
    category = column_or_null(rows, "categoria sku")
    values: dict[str, Column] = {
        new: column_or_null(rows, old) for new, old in PANEL_PRODUCT_SOURCES.items()
    }
    values["Gramos"] = thousands_number(content)
    values["Presentacion_Producto"] = presentation_text(content, category) if has_content else F.lit("-")
    for name, value in {**PANEL_PRODUCT_DEFAULTS, **(constants or {})}.items():
        values[name] = F.lit(value)
    return rows.select(F.lit(False).alias(FLAG), *_laid_out(values, layout))


def panel_store_queue(feed: DataFrame, dim: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Panel stores the dimension lacks: the flag, then the feed's own store columns."""
    require_columns(feed, ["codigo unico pdv"], "panel feed")
    rows = _first_missing(feed, dim, "codigo unico pdv", "Id_Comercial", order_by)
    return rows.select(
        F.lit(False).alias(FLAG), *[column_or_null(rows, c).alias(c) for c in PANEL_STORE_QUEUE]
    )


def _first_missing(
    feed: DataFrame, dim: DataFrame, key: str, dim_key: str, order_by: Sequence[str]
) -> DataFrame:
    known = dim.select(F.col(quoted(dim_key)).cast("string").alias(dim_key))
    return first_row(anti_by_key(feed, known, key, dim_key), [key], order_by)
