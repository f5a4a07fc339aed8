"""The panel feed: clean, derive, correct names, validate, replace the months found."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gondola.functions.dates import date_from_parts, month_number, period, previous_month_start
from gondola.functions.numbers import number_or_zero, thousands_number
from gondola.functions.retail import fixed_store_code, store_type
from gondola.functions.text import missing_to_null, upper_trim
from gondola.operators.joins import correct_store_names, key_flags
from gondola.operators.measures import bounded_measure, panel_measures, panel_volume, units_or_quantity
from gondola.operators.numbering import run_row_ids
from gondola.operators.replace import rejects_by_reason
from gondola.operators.review import panel_product_queue, panel_store_queue
from gondola.operators.schema import SOURCE_ORDER, column_or_null, computed, on_texts, put_first, quoted
from gondola.operators.store import Store
from gondola.session import scratch_removed, written, written_counted
from gondola.sources import selection, tables
from gondola.sources.feeds import read_feed

# Columns that are cleaned, fact names of feed columns, the fact layout.
CLEANED = (
    "nombre pdv", "estado pdv", "localidad pdv", "direccion pdv", "pdv clasif 3",
    "categoria sku", "prod clasif 5", "prod clasif 6", "prod clasif 7",
    "prod clasif 8", "prod clasif 9", "prod clasif 10", "escencia", "sabor",
)
FACT_NAMES = {
    "codigo unico pdv": "Id_Comercial",
    "codigo barras sku": "Id_Producto",
    "precio por unidad": "Precio_Unitario",
    "cantidad de venta": "Cantidad",
    "ventas en valor": "Facturacion_Gs",
    "fecha": "Fecha",
}
FIRST_COLUMNS = ("Id", "Fecha", "Id_Comercial", "Id_Producto", "Cantidad", "Precio_Unitario", "Facturacion_Gs", "cajas", "fardos", "kilos")
FACT_LAYOUT = ("Id", "Fecha", "Id_Comercial", "Id_Producto", "Cantidad", "Precio_Unitario", "Facturacion_Gs", "unidades", "cajas", "fardos", "kilos")
AMOUNTS = ("Cantidad", "Precio_Unitario", "Facturacion_Gs")
REASONS = {"missing_product": "missing_product", "missing_store": "missing_store", "bad_date": "bad_date"}


def prepare(feed: DataFrame, name_mapping: DataFrame | None = None) -> DataFrame:
    """Cleaned feed rows with month number, ``fecha``, store type and measures.

    Narrow work in one stage, but for the lookup of corrected store names.
    """
    feed = on_texts(feed, missing_to_null)
    feed = feed.withColumns({c: upper_trim(F.col(quoted(c))) for c in CLEANED if c in feed.columns})
    if "mes de fecha" in feed.columns:
        feed = feed.withColumn("mes de fecha", month_number(F.col("`mes de fecha`")))
    if "codigo unico pdv" in feed.columns:
        feed = feed.withColumn("codigo unico pdv", fixed_store_code(F.col("`codigo unico pdv`")))
    if "pdv clasif 3" in feed.columns:
        feed = feed.withColumn("tipo_de_comercio", store_type(F.col("`pdv clasif 3`")))

    # Each step reads the columns of the one before, so nothing is parsed twice.
    sources = {"_sales": "ventas en volumen", "_quantity": "cantidad de venta", "_content": "cant contenido sku"}
    day = date_from_parts(
        *[column_or_null(feed, c) for c in ("ano de fecha", "mes de fecha", "dia de fecha")]
    )
    feed = computed(
        feed, {"fecha": day} | {new: number_or_zero(column_or_null(feed, old)) for new, old in sources.items()}
    )
    volume = panel_volume(F.col("_sales"), F.col("_quantity"), F.col("_content"))
    feed = feed.withColumn("_volume", volume)
    measures = panel_measures(
        column_or_null(feed, "categoria sku"),
        column_or_null(feed, "prod clasif 10"),
        F.col("_volume"),
        F.col("_quantity"),
        F.col("_content"),
    )
    return correct_store_names(feed.withColumns(measures).drop(*sources, "_volume"), name_mapping)


def fact_candidates(prepared: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Prepared rows under the fact's names, amounts parsed.

    The measures are numbers already; only the raw amount texts are parsed here.
    """
    named = prepared.withColumnsRenamed(FACT_NAMES)
    texts = {c for c, t in named.dtypes if t == "string"}
    named = named.withColumns({c: thousands_number(F.col(c)) for c in AMOUNTS if c in texts})
    return named.select(*[quoted(c) for c in columns]) if columns else named


def with_ids(
    candidates: DataFrame, run_stamp: str, order_by: Sequence[str] = SOURCE_ORDER, stored: bool = False
) -> DataFrame:
    """Add ``Id`` to the whole batch, before validation, and put the fact's columns first."""
    return put_first(run_row_ids(candidates, order_by, run_stamp, stored), FIRST_COLUMNS)


def flag_rows(rows: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    """Rows with what is wrong: missing product, missing store, no date."""
    flagged = key_flags(rows, stores, products, "Id_Comercial", "Id_Producto")
    return flagged.withColumns(
        {
            "missing_product": ~F.col("has_product"),
            "missing_store": ~F.col("has_store"),
            "bad_date": F.col("Fecha").isNull(),
        }
    ).drop("has_product", "has_store")


def _wrong():
    return F.col("missing_product") | F.col("missing_store") | F.col("bad_date")


def fact(flagged: DataFrame) -> DataFrame:
    """Valid rows in the fact layout, measures bounded."""
    ok = flagged.filter(~_wrong())
    units = F.col("unidades").try_cast("bigint") if "unidades" in ok.columns else None
    ok = ok.withColumns(
        {"unidades": units_or_quantity(units, F.col("Cantidad"))}
        | {c: bounded_measure(F.col(c)) for c in ("kilos", "cajas", "fardos")}
    )
    return ok.select(*[c for c in FACT_LAYOUT if c in ok.columns])


def rejects(flagged: DataFrame) -> DataFrame:
    """Rows not loaded, once per reason."""
    return rejects_by_reason(flagged.filter(_wrong()), REASONS)


def run_counts(flagged: DataFrame) -> dict[str, Column]:
    """The rows of a panel run by what was found, as aggregates of ``flag_rows``."""
    product, store = ~F.col("missing_product"), ~F.col("missing_store")
    return {
        "rows_in": F.count(F.lit(1)), "product_matched": F.count_if(product), "store_matched": F.count_if(store),
        "matched": F.count_if(product & store), "bad_date": F.count_if(F.col("bad_date")), "loaded": F.count_if(~_wrong()),
    }


COUNTERS = (
    "rows_in bigint, product_matched bigint, store_matched bigint, matched bigint, bad_date bigint, loaded bigint, "
    "products_queued bigint, stores_queued bigint"
)


def counters(flagged: DataFrame, queued: tuple[DataFrame, DataFrame]) -> DataFrame:
    """One row: rows in, matched by product, by store and by both, without a date and loaded; products and stores queued."""
    row = flagged.agg(*[m.alias(n) for n, m in run_counts(flagged).items()])
    for queue, name in zip(queued, ("products_queued", "stores_queued")):
        # One row to one row; the key keeps it from being a product of tables.
        one = queue.agg(F.count(F.lit(1)).alias(name)).withColumn("_one", F.lit(1))
        row = row.withColumn("_one", F.lit(1)).join(one, "_one").drop("_one")
    return row


def run(
    feed: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    run_stamp: str,
    out: str,
    product_layout: Sequence[str],
    name_mapping: DataFrame | None = None,
    constants: Mapping[str, object] | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Load a panel feed from ``read_feed`` into the store ``out``: fact, rejects and both queues.

    Replaces the months that occur among the valid rows; without any valid row the fact
    stays as it is, but matched rows that all lack a date are an error. All four tables change
    together or, if the run stops, not at all (``operators.store``). Returns the run's
    ``counters``, taken while writing; the store keeps them too. A dry run writes nothing at all.
    """
    spark = feed.sparkSession
    prepared = prepare(feed, name_mapping)
    if dry_run:
        queues = panel_product_queue(prepared, products, product_layout, constants, SOURCE_ORDER), panel_store_queue(prepared, stores, SOURCE_ORDER)
        return counters(flag_rows(fact_candidates(prepared), stores, products), queues)
    with scratch_removed(spark):
        counts = _load(written(prepared), products, stores, run_stamp, Store(spark, out), product_layout, constants)
    return spark.createDataFrame([tuple(counts.values())], COUNTERS)


def _load(
    prepared: DataFrame, products: DataFrame, stores: DataFrame, run_stamp: str, store: Store,
    product_layout: Sequence[str], constants: Mapping[str, object] | None,
) -> dict[str, int]:
    flagged = flag_rows(with_ids(fact_candidates(prepared), run_stamp, stored=True), stores, products)
    flagged, counts = written_counted(flagged, run_counts(flagged))
    if counts["matched"] and not counts["loaded"]:
        raise ValueError("no matched row has a date, so no month can be replaced")
    load = store.load()
    dated = fact(flagged).withColumn("period", period(F.col("Fecha")))
    load.put("fact", dated, ["period"])
    load.put("rejects", rejects(flagged), ["reason"], replaced=[{"reason": r} for r in REASONS.values()])
    queue = panel_product_queue(prepared, products, product_layout, constants, SOURCE_ORDER)
    one = {"n": F.count(F.lit(1))}
    counts["products_queued"] = load.put("product_queue", queue, metrics=one)["n"]
    counts["stores_queued"] = load.put("store_queue", panel_store_queue(prepared, stores, SOURCE_ORDER), metrics=one)["n"]
    load.publish(run="panel", stamp=run_stamp, counters=counts)
    return counts


def run_day(
    spark: SparkSession, folder: str, day: datetime.date, products: str, stores: str, run_stamp: str, out: str,
    name_mapping: str | None = None, **options,
) -> DataFrame | None:
    """From the run day to the loaded feed: pick the file of the month before below ``folder``, read, ``run``.

    ``products``, ``stores`` and ``name_mapping`` are paths. None if there is no such file.
    """
    files = selection.best_files(selection.panel_candidates(selection.list_files(spark, folder)))
    picked = selection.files_for_month(files, previous_month_start(F.lit(day))).first()
    if picked.outcome != "found":
        return None
    products_table = tables.read_dimension(spark, products)
    names = tables.read_store_names(spark, name_mapping) if name_mapping else None
    return run(
        read_feed(spark, [picked.path], "panel"), products_table, tables.read_dimension(spark, stores), run_stamp, out,
        products_table.columns, names, **options,
    )
