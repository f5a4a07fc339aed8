"""One query per operator or group of operators, over whole tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.functions import dates, flags, numbers, retail, text
from gondola.operators import dedup, dimensions, joins, measures, numbering, promotion, quality, replace, review
from gondola.operators.schema import clean_cells, computed, keep_enabled, split_by_flag, strip_cells
from gondola.plans import chain, panel
from gondola.session import tune
from gondola.sources import selection, tables
from workload.inputs import load

Query = Callable[[SparkSession, str], DataFrame]

# The columns of the dimension tables, in their order.
PRODUCT_LAYOUT = (
    "producto", "proveedor", "categoria", "marca", "clasificacion", "presentacion", "variedad", "talle", "segmento",
    "promocion", "ean", "gramaje", "sub_segmento", "sub_marca", "sabor", "especialidad", "sub_categoria",
)
STORE_LAYOUT = (
    "id_sucursal_bg", "nombre_local", "latitud", "longitud", "ciudad", "cod_cliente", "autocompra",
    "compra_balanceado", "AC_yerba_exhibidores", "ac_pod_cigarreras",
)
PANEL_PRODUCT_LAYOUT = (
    "Id_Producto", "Descripcion_del_Producto", "Marca", "Categoria", "Segmento", "Sub_Segmento", "Variedades",
    "Presentacion_Producto", "Proveedor", "Propio_Otros", "especialidad", "talle", "unidades", "Gramos",
    "es_promo", "Empaque", "clasificacion",
)
CHAIN_ORDER = ("day", "id_sucursal", "codigo de barras", "units", "amount", "familia", "source_file", "source_row")
PANEL_ORDER = ("Fecha", "Id_Comercial", "Id_Producto", "Cantidad", "Precio_Unitario", "Facturacion_Gs", "kilos", "cajas", "fardos", "source_file", "source_row")
STAMP = "0801093000000000"

_registry: dict[str, Query] = {}


def query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    def tuned(function: Query) -> Query:
        return lambda spark, sf_dir: function(tune(spark), sf_dir)

    return {name: tuned(function) for name, function in _registry.items()}


# ---- chain feed ---------------------------------------------------------------


def chain_tagged(
    spark: SparkSession, sf_dir: str, month: datetime.date | None = None, categories: Sequence[str] | None = None
) -> DataFrame:
    return chain.tag_rows(
        clean_cells(load(spark, sf_dir, "chain_feed")),
        load(spark, sf_dir, "chain_products"),
        load(spark, sf_dir, "chain_stores"),
        month,
        categories,
    )


@query
def chain_fact(spark, sf_dir):
    """The whole chain feed: keys, measures, dollars, row index, wide layout."""
    return chain.fact(chain_tagged(spark, sf_dir), CHAIN_ORDER)


def _category_query(category: str) -> Query:
    def one(spark, sf_dir):
        tagged = chain_tagged(spark, sf_dir, categories=[category])
        return chain.category_fact(chain.fact(tagged, CHAIN_ORDER), category)

    one.__name__ = f"chain_fact_{category.lower()}"
    return query(one)


for _category in chain.LAYOUTS:
    _category_query(_category)


@query
def chain_rejects(spark, sf_dir):
    """Chain rows not loaded in a run for March 1998, once per reason."""
    bad = chain.rejects(chain_tagged(spark, sf_dir, datetime.date(1998, 3, 1)))
    return bad.select("category", "fecha", "id_sucursal", F.col("`codigo de barras`").alias("codigo"), "unidades vendidas", "total facturado", "reason")


@query
def chain_enabled_categories(spark, sf_dir):
    """Row counts of the categories that are switched on."""
    feed = load(spark, sf_dir, "chain_feed")
    return quality.frequencies(keep_enabled(feed, chain.enabled_categories()), "category")


@query
def chain_product_queue(spark, sf_dir):
    return chain.product_queue(chain_tagged(spark, sf_dir), PRODUCT_LAYOUT)


@query
def chain_store_queue(spark, sf_dir):
    return chain.store_queue(chain_tagged(spark, sf_dir), STORE_LAYOUT)


@query
def run_counters(spark, sf_dir):
    return chain.counters(chain_tagged(spark, sf_dir))


@query
def load_row_index(spark, sf_dir):
    """Row number within each category and month of the feed's dated rows."""
    feed = load(spark, sf_dir, "chain_feed")
    rows = feed.select(
        "category",
        dates.day_month_year(F.col("fecha")).alias("day"),
        "sucursal",
        "descripcion",
        "source_file",
        "source_row",
    ).withColumn("period", dates.period(F.col("day")))
    order = ["day", "sucursal", "descripcion", "source_file", "source_row"]
    return numbering.load_index(rows, order, ["category", "period"]).drop("source_file", "source_row")


# ---- joins --------------------------------------------------------------------


def _sales(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    feed = load(spark, sf_dir, "chain_feed").select(text.strip(F.col("`codigo de barras`")).alias("codigo de barras"), "marca", "fecha")
    products = load(spark, sf_dir, "chain_products").withColumn("ean", numbers.barcode_digits(F.col("ean")))
    fact = computed(feed, {"codigo": numbers.integer_key(F.col("`codigo de barras`"))}).select("codigo", "marca", "fecha")
    dim = products.select(
        numbers.without_leading_zeros(F.col("ean")).alias("ean"), "gramaje", "presentacion", "marca"
    )
    return fact, dim


def _join_query(how: str) -> Query:
    def one(spark, sf_dir):
        return joins.validated_join(*_sales(spark, sf_dir), "codigo", "ean", how)[0]

    one.__name__ = f"validated_join_{how}"
    return query(one)


for _how in joins.HOW:
    _join_query(_how)


@query
def join_provenance(spark, sf_dir):
    """How many rows each side contributes to the full outer join, per key length."""
    both = joins.provenance(*_sales(spark, sf_dir), "codigo", "ean")
    return quality.frequencies(both.select("origin", F.length(F.coalesce("codigo", "ean")).alias("digits")), "origin", "digits")


@query
def unmatched_products(spark, sf_dir):
    """Fact rows without a product, the first per code."""
    return joins.validated_join(*_sales(spark, sf_dir), "codigo", "ean")[1]


@query
def key_validation_flags(spark, sf_dir):
    """Panel rows by what their keys are found in, both checked on every row."""
    rows = load(spark, sf_dir, "panel_feed").select(
        F.col("`codigo unico pdv`").alias("Id_Comercial"), F.col("`codigo barras sku`").alias("Id_Producto")
    )
    flagged = joins.key_flags(
        rows, load(spark, sf_dir, "panel_stores"), load(spark, sf_dir, "panel_products"), "Id_Comercial", "Id_Producto"
    )
    return quality.frequencies(flagged, "Id_Comercial", "has_product", "has_store")


@query
def store_id_mapping(spark, sf_dir):
    return tables.store_id_mapping(load(spark, sf_dir, "store_ids"), ["orden"])


def _remapped(spark, sf_dir):
    feed = load(spark, sf_dir, "chain_feed").select("id_sucursal", F.col("sucursal").alias("nombre_local"), "fecha")
    return joins.remap_store_ids(feed, store_id_mapping(spark, sf_dir), "id_sucursal", "nombre_local")


@query
def store_id_remap(spark, sf_dir):
    return _remapped(spark, sf_dir)


@query
def store_id_remap_count(spark, sf_dir):
    return quality.remap_count(_remapped(spark, sf_dir))


@query
def store_name_fix(spark, sf_dir):
    """Corrected names by name and legal name."""
    feed = load(spark, sf_dir, "panel_feed").select("codigo unico pdv", text.upper_trim(F.col("`nombre pdv`")).alias("nombre pdv"), "pdv_razon_social")
    return joins.correct_store_names(feed, tables.store_name_mapping(load(spark, sf_dir, "store_names")))


@query
def store_name_fix_by_name(spark, sf_dir):
    """Corrected names by name alone, where the feed has no legal name."""
    feed = load(spark, sf_dir, "panel_feed").select("codigo unico pdv", text.upper_trim(F.col("`nombre pdv`")).alias("nombre pdv"))
    return joins.correct_store_names(feed, tables.store_name_mapping(load(spark, sf_dir, "store_names")))


@query
def insert_if_absent(spark, sf_dir):
    """The store dimension after the feed's stores came in."""
    existing = load(spark, sf_dir, "panel_stores")
    new = dimensions.store_dimension(panel.prepare(load(spark, sf_dir, "panel_feed")))
    return dimensions.insert_if_absent(existing, new, "Id_Comercial", sorted(new.columns))


# ---- scalars ------------------------------------------------------------------


@query
def canonical_product_key(spark, sf_dir):
    """Digits and canonical key of every product code as it came, in feed and dimension."""
    feed = load(spark, sf_dir, "chain_feed").select(F.col("`codigo de barras`").alias("codigo"))
    codes = feed.union(load(spark, sf_dir, "chain_products").select("ean"))
    code = F.col("_stripped")
    return codes.withColumn("_stripped", text.strip(F.col("codigo"))).select(
        "codigo",
        numbers.barcode_digits(code).alias("digits"),
        numbers.integer_key(code).alias("key"),
        numbers.store_code(code).alias("as_store"),
    )


@query
def spanish_numbers(spark, sf_dir):
    """Each raw panel number through both parsers."""
    feed = load(spark, sf_dir, "panel_feed")
    columns = ["cant contenido sku", "ventas en volumen", "cantidad de venta", "precio por unidad", "ventas en valor"]
    parsed = []
    for i, name in enumerate(columns):
        value = F.col(f"`{name}`")
        parsed += [
            numbers.number_or_zero(value).alias(f"zero_{i}"),
            numbers.thousands_number(value).alias(f"thousands_{i}"),
        ]
    return feed.select(*columns, *parsed)


@query
def text_cleanup(spark, sf_dir):
    feed = load(spark, sf_dir, "panel_feed")
    name, kind, place = F.col("`nombre pdv`"), F.col("`categoria sku`"), F.col("`localidad pdv`")
    return feed.select(
        F.col("`nombre pdv`").alias("nombre"),
        text.strip(name).alias("stripped"),
        text.upper_trim(name).alias("upper_name"),
        text.match_key(name).alias("key"),
        text.strip_accents(kind).alias("plain_kind"),
        text.upper_trim(place).alias("upper_place"),
        text.safe_text(F.col("`cant contenido sku`")).alias("safe_content"),
        text.missing_to_null(F.col("`cant contenido sku`")).alias("content"),
        numbers.whole_number(F.col("`cant contenido sku`")).alias("whole_content"),
    )


@query
def code_and_month_substitution(spark, sf_dir):
    feed = load(spark, sf_dir, "panel_feed")
    return feed.select(
        "codigo unico pdv",
        "mes de fecha",
        retail.fixed_store_code(F.col("`codigo unico pdv`")).alias("code"),
        dates.month_number(F.col("`mes de fecha`")).alias("month"),
    )


@query
def store_type(spark, sf_dir):
    feed = load(spark, sf_dir, "panel_feed")
    typed = feed.select("pdv clasif 3", retail.store_type(F.col("`pdv clasif 3`")).alias("tipo_de_comercio"))
    return quality.frequencies(typed, "pdv clasif 3", "tipo_de_comercio")


@query
def presentation_texts(spark, sf_dir):
    feed = load(spark, sf_dir, "panel_feed")
    made = feed.select(
        "cant contenido sku",
        "categoria sku",
        retail.presentation_text(F.col("`cant contenido sku`"), F.col("`categoria sku`")).alias("presentacion"),
    )
    return quality.frequencies(made, *made.columns)


@query
def date_rules(spark, sf_dir):
    """Month limits, target day and month names of every ship date; dates put together again."""
    feed = load(spark, sf_dir, "panel_feed")
    day = dates.date_from_parts(F.col("`ano de fecha`"), dates.month_number(F.col("`mes de fecha`")), F.col("`dia de fecha`"))
    return feed.select(day.alias("day")).select(
        "day",
        dates.month_start("day").alias("month_start"),
        dates.next_month_start("day").alias("next_start"),
        dates.previous_month_start("day").alias("previous_start"),
        dates.target_day(F.col("day")).alias("target"),
        dates.month_name("day").alias("month_name"),
        dates.period(F.col("day")).alias("period"),
        dates.reparsed_date(F.col("day")).alias("again"),
    )


@query
def chain_dates(spark, sf_dir):
    """dd/mm/yyyy texts, impossible days as NULL."""
    feed = load(spark, sf_dir, "chain_feed")
    return quality.frequencies(feed.select("fecha", dates.day_month_year(F.col("fecha")).alias("day")), "fecha", "day")


def _flag_query(mode: str) -> Query:
    def one(spark, sf_dir):
        queue = load(spark, sf_dir, "queue").select("event_id", F.col("`Para Escritura`").alias("flag"), "value")
        kinds = {f.name: f.dataType for f in queue.schema}
        return queue.select(
            "event_id",
            "flag",
            flags.approved(F.col("flag"), kinds["flag"], mode).alias("by_text"),
            flags.approved(F.col("value") - 5, kinds["value"], mode).alias("by_number"),
        )

    one.__name__ = f"flag_parse_{mode}"
    return query(one)


for _mode in ("lenient", "strict"):
    _flag_query(_mode)


@query
def flag_values(spark, sf_dir):
    """Distinct raw flags."""
    return quality.distinct_values(load(spark, sf_dir, "queue"), "Para Escritura")


# ---- panel feed ---------------------------------------------------------------


def _panel_candidates(spark, sf_dir) -> DataFrame:
    mapping = tables.store_name_mapping(load(spark, sf_dir, "store_names"))
    prepared = panel.prepare(load(spark, sf_dir, "panel_feed"), mapping)
    return panel.fact_candidates(prepared, PANEL_ORDER)


def _panel_flagged(spark, sf_dir) -> DataFrame:
    return panel.flag_rows(
        panel.with_ids(_panel_candidates(spark, sf_dir), STAMP, PANEL_ORDER),
        load(spark, sf_dir, "panel_stores"),
        load(spark, sf_dir, "panel_products"),
    )


@query
def panel_fact(spark, sf_dir):
    """The whole panel feed: cleaned, measured, numbered, validated, bounded."""
    return panel.fact(_panel_flagged(spark, sf_dir))


@query
def rejects_by_reason(spark, sf_dir):
    """Panel rows not loaded, once per reason."""
    bad = panel.rejects(_panel_flagged(spark, sf_dir))
    return bad.select("Id", "Fecha", "Id_Comercial", "Id_Producto", "reason")


@query
def panel_run_counters(spark, sf_dir):
    """What a panel run counts: rows matched, without a date and loaded, keys queued."""
    stores, products = load(spark, sf_dir, "panel_stores"), load(spark, sf_dir, "panel_products")
    mapping = tables.store_name_mapping(load(spark, sf_dir, "store_names"))
    prepared = panel.prepare(load(spark, sf_dir, "panel_feed"), mapping)
    queues = review.panel_product_queue(prepared, products, PANEL_PRODUCT_LAYOUT), review.panel_store_queue(prepared, stores)
    return panel.counters(panel.flag_rows(panel.fact_candidates(prepared), stores, products), queues)


@query
def run_row_id(spark, sf_dir):
    rows = panel.with_ids(_panel_candidates(spark, sf_dir), STAMP, PANEL_ORDER)
    return rows.select("Id", "Fecha", "Id_Comercial", "Id_Producto")


@query
def panel_measures(spark, sf_dir):
    """Measures per row, raw and bounded."""
    prepared = panel.prepare(load(spark, sf_dir, "panel_feed"))
    bounded = {f"{c}_bounded": measures.bounded_measure(F.col(c) * 10000) for c in ("kilos", "cajas", "fardos")}
    return prepared.withColumns(bounded).select(
        "categoria sku", "prod clasif 10", "fecha", "tipo_de_comercio", "kilos", "cajas", "fardos", *bounded
    )


@query
def panel_product_queue(spark, sf_dir):
    feed = panel.prepare(load(spark, sf_dir, "panel_feed"))
    used = [c for c in feed.columns if c in review.PANEL_PRODUCT_SOURCES.values()]
    order = [*used, "cant contenido sku"]
    return review.panel_product_queue(
        feed, load(spark, sf_dir, "panel_products"), PANEL_PRODUCT_LAYOUT, {"Propio_Otros": "OTROS"}, order
    )


@query
def panel_store_queue(spark, sf_dir):
    feed = panel.prepare(load(spark, sf_dir, "panel_feed"))
    order = ["nombre pdv", "pdv clasif 3", "pdv ruc", "pdv_razon_social", "estado pdv", "localidad pdv", "direccion pdv"]
    return review.panel_store_queue(feed, load(spark, sf_dir, "panel_stores"), order)


@query
def product_dimension_from_feed(spark, sf_dir):
    return dimensions.product_dimension(panel.prepare(load(spark, sf_dir, "panel_feed")))


@query
def store_dimension_from_feed(spark, sf_dir):
    return dimensions.store_dimension(panel.prepare(load(spark, sf_dir, "panel_feed")))


# ---- promotion ----------------------------------------------------------------


def _promotion(spark, sf_dir, entity: str) -> tuple[promotion.Promotion, DataFrame]:
    queue = load(spark, sf_dir, "queue").drop("value")
    if entity == "chain_products":
        queue = queue.select(F.col("clave").alias("ean"), F.col("nombre").alias("producto"), F.col("codigo").alias("gramaje"), "event_id", "Para Escritura")
        dim = load(spark, sf_dir, "chain_products").select(
            numbers.without_leading_zeros(numbers.barcode_digits(F.col("ean"))).alias("ean"), "producto", F.col("presentacion").alias("gramaje")
        )
        return promotion.promote(queue, dim, "ean", "lenient", order_by=["producto", "gramaje"]), dim
    if entity == "chain_stores":
        queue = queue.select(F.col("clave").alias("id_sucursal_bg"), F.col("nombre").alias("nombre_local"), "event_id", "Para Escritura")
        dim = load(spark, sf_dir, "chain_stores").select(text.safe_text(F.col("id_sucursal_bg")).alias("id_sucursal_bg"), "nombre_local")
        return promotion.promote(queue, dim, "id_sucursal_bg", "lenient", order_by=["nombre_local"]), dim
    if entity == "panel_products":
        queue = queue.select(F.col("clave").alias("Id_Producto"), F.col("nombre").alias("Marca"), F.col("codigo").alias("Gramos"), "event_id", "Para Escritura")
        dim = load(spark, sf_dir, "panel_products").select("Id_Producto", "Marca", "Gramos", "talle")
        return promotion.promote(queue, dim, "Id_Producto", "strict", order_by=["Marca", "Gramos"]), dim
    queue = queue.select(F.col("clave").alias("Código único PDV"), F.col("nombre").alias("Nombre PDV"), F.col("codigo").alias("Pdv RUC"), "event_id", "Para Escritura")
    dim = load(spark, sf_dir, "panel_stores").select("Id_Comercial", "Nombre_PDV", "RUC_PDV")
    return (
        promotion.promote(queue, dim, "Id_Comercial", "strict", promotion.PANEL_STORE_RENAMES, ["Nombre_PDV", "RUC_PDV"]),
        dim,
    )


def _promotion_query(entity: str) -> Query:
    def one(spark, sf_dir):
        promoted, dim = _promotion(spark, sf_dir, entity)
        return promoted.dimension_after(dim)

    one.__name__ = f"promote_{entity}"
    return query(one)


for _entity in ("chain_products", "chain_stores", "panel_products", "panel_stores"):
    _promotion_query(_entity)


@query
def promotion_counters(spark, sf_dir):
    """Rows inserted and rows that stay, per review queue."""
    parts = [
        promotion.counted(_promotion(spark, sf_dir, entity)[0]).withColumn("queue", F.lit(entity))
        for entity in ("chain_products", "chain_stores", "panel_products", "panel_stores")
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def queue_remaining(spark, sf_dir):
    return _promotion(spark, sf_dir, "chain_products")[0].remaining


@query
def queue_split(spark, sf_dir):
    """Approved and pending rows per spelling of the flag."""
    approved, pending = split_by_flag(promotion.with_flag(load(spark, sf_dir, "queue"), "lenient"), review.FLAG)
    both = approved.withColumn("part", F.lit("approved")).unionByName(pending.withColumn("part", F.lit("pending")))
    return quality.frequencies(both, "part", review.FLAG)


# ---- replacing months ---------------------------------------------------------


def _existing(spark, sf_dir) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    day = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("date"))
    return orders.select(F.col("o_orderkey").alias("id"), day.alias("fecha"), F.col("o_totalprice").alias("monto"))


def _arriving(spark, sf_dir) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").cast("date").alias("fecha"), F.col("l_extendedprice").alias("monto"))


@query
def replace_month(spark, sf_dir):
    """The orders with March 1998 replaced by that month's lines."""
    start, end = replace.month_bounds(datetime.date(1998, 3, 15))
    month = _arriving(spark, sf_dir).filter((F.col("fecha") >= F.lit(start)) & (F.col("fecha") < F.lit(end)))
    return replace.replace_month(_existing(spark, sf_dir), month, start, end)


@query
def replace_periods_found(spark, sf_dir):
    """The orders, a year earlier, with every month of all lines replaced; the months before them stay."""
    existing = _existing(spark, sf_dir).withColumn("fecha", F.add_months("fecha", -12))
    return replace.replace_periods_found(existing, _arriving(spark, sf_dir), "fecha")


@query
def periods_in_batch(spark, sf_dir):
    return dedup.distinct_periods(_arriving(spark, sf_dir), "fecha").orderBy("period")


# ---- files --------------------------------------------------------------------


def _file_query(name: str, listing: str, candidates: Callable, loose: bool, by: tuple[str, ...]) -> Query:
    def one(spark, sf_dir):
        # A path listed more than once counts with its latest time.
        files = load(spark, sf_dir, listing).groupBy("path").agg(F.max("modified").alias("modified"))
        best = selection.best_files(candidates(selection.with_names(files), loose), *by)
        return best.select(*by, "period", "path", "modified", "quality")

    one.__name__ = name
    return query(one)


_file_query("newest_chain_file", "file_listing", selection.chain_candidates, False, ("category",))
_file_query("newest_chain_file_loose", "file_listing", selection.chain_candidates, True, ("category",))
_file_query("newest_panel_file", "panel_listing", selection.panel_candidates, False, ())
_file_query("newest_panel_file_loose", "panel_listing", selection.panel_candidates, True, ())


@query
def files_for_run_day(spark, sf_dir):
    """What a chain run on 1 April 1998 loads: March's best file of each category, or none."""
    files = load(spark, sf_dir, "file_listing").groupBy("path").agg(F.max("modified").alias("modified"))
    best = selection.best_files(selection.chain_candidates(selection.with_names(files), True), "category")
    return selection.files_for_month(best, dates.target_day(F.lit(datetime.date(1998, 4, 1))), chain.enabled_categories())


# ---- quality ------------------------------------------------------------------


@query
def bad_numeric_rows(spark, sf_dir):
    feed = load(spark, sf_dir, "chain_feed")
    context = ["category", "fecha", "id_sucursal", "codigo de barras"]
    units = quality.bad_numbers(feed, "unidades vendidas", context).withColumn("column", F.lit("units"))
    return units.unionByName(quality.bad_numbers(feed, "total facturado", context).withColumn("column", F.lit("amount")))


@query
def top_bad_values(spark, sf_dir):
    feed = load(spark, sf_dir, "chain_feed")
    return quality.top_values(quality.bad_numbers(feed, "unidades vendidas"), "bad_value", 20)


@query
def value_frequencies(spark, sf_dir):
    return quality.frequencies(load(spark, sf_dir, "queue"), "Para Escritura")


def _profile_query(name: str, group_by: tuple[str, ...]) -> Query:
    def one(spark, sf_dir):
        feed = load(spark, sf_dir, "panel_feed")
        values = feed.select(
            F.upper(F.trim("categoria sku")).alias("kind"),
            numbers.number_or_zero(F.col("`ventas en volumen`")).alias("volume"),
        )
        profile = quality.numeric_profile(values, "volume", group_by)
        rounded = {c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")}
        return profile.withColumns(rounded)

    one.__name__ = name
    return query(one)


_profile_query("numeric_profile", ())
_profile_query("numeric_profile_by_category", ("kind",))


@query
def numeric_profile_fine(spark, sf_dir):
    """A profile of values with many decimals: the tax on each line's discount."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    values = lines.select((F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax")).cast("double").alias("x"))
    rounded = {c: F.round(c, 6) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")}
    return quality.numeric_profile(values, "x").withColumns(rounded)


#: What is added to supplier keys so that doubles, or longs, no longer hold all of them.
WIDE_DOUBLE, WIDE_LONG = 1 << 53, 10 ** 34


@query
def validated_join_mixed_types(spark, sf_dir):
    """Lines against suppliers with keys of two types: text with zeros in front or digits behind the
    point, longs against doubles beyond their exact range, 35-digit text against decimals."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_suppkey", F.col("l_linenumber").cast("int").alias("line"))
    stores = spark.read.parquet(f"{sf_dir}/supplier.parquet").filter("s_suppkey % 9 <> 4")
    key, text = F.col("l_suppkey"), F.col("l_suppkey").cast("string")
    supplier = F.col("s_suppkey")
    digits = F.when(F.col("line") % 2 == 0, ".000").otherwise(".00000000001")
    even = stores.filter("s_suppkey % 2 = 0")
    wide = F.lit(str(WIDE_LONG)).cast("decimal(38,0)")
    cases = {
        "zeros": (F.concat(F.lit("00"), text), stores, supplier.cast("decimal(12,2)")),
        "digits": (F.concat(text, digits), stores, supplier.cast("int")),
        "double": (key.cast("bigint") + F.lit(WIDE_DOUBLE), even, (supplier.cast("bigint") + F.lit(WIDE_DOUBLE)).cast("double")),
        "wide": ((key.cast("decimal(38,0)") + wide).cast("decimal(38,0)").cast("string"), stores, (supplier.cast("decimal(38,0)") + wide).cast("decimal(38,0)")),
    }
    parts = []
    for name, (left, dim, right) in cases.items():
        fact = lines.select(left.alias("store"), "line")
        joined = joins.validated_join(fact, dim.select(right.alias("id"), "s_name"), "store", "id", "left")[0]
        parts.append(joined.select(F.lit(name).alias("kind"), F.col("store").cast("string").alias("store"), "line", "s_name"))
    return reduce(DataFrame.unionByName, parts)
