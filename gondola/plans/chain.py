"""The chain feed: validate, derive measures, number, replace the month, queue the rest."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from gondola.functions.dates import day_month_year, month_start, period, target_day
from gondola.functions.numbers import (
    barcode_digits, integer_key, is_bad_number, plain_number, store_code, without_leading_zeros,
)
from gondola.functions.text import strip
from gondola.operators import quality
from gondola.operators.dedup import keep_first
from gondola.operators.joins import with_key_flag
from gondola.operators.measures import CIGARETTES, chain_measures, dollars
from gondola.operators.numbering import load_index
from gondola.operators.replace import rejects_by_reason
from gondola.operators.review import chain_product_queue, chain_store_queue
from gondola.operators.schema import (
    SOURCE_ORDER, column_or_null, computed, keep_enabled, quoted, require_columns, strip_cells,
)
from gondola.operators.store import Store
from gondola.session import scratch_removed, written_counted
from gondola.sources import selection, tables
from gondola.sources.feeds import read_feed

# The categories in load order, whether they are on, and the columns
# of their fact tables.
CATEGORIES = {"YERBA": True, "VAPES": True, "PANALES": True, "CARAMELOS": False, "BALANCEADOS": False, "CIGARRILLOS": True}
LAYOUTS = {
    "YERBA": ["index", "fecha", "id_sucursal_bg", "unidades", "kilos", "facturacion_gs", "facturacion_dolar", "precio_prom_gs", "sku"],
    "VAPES": ["index", "fecha", "id_sucursal_bg", "unidades", "facturacion_gs", "facturacion_dolar", "precio_prom_gs", "sku"],
    "PANALES": ["index", "fecha", "id_sucursal_bg", "unidades", "paquetes", "fardos", "facturacion_gs", "facturacion_dolar", "precio_prom_gs", "sku"],
    "CARAMELOS": ["index", "fecha", "id_sucursal_bg", "unidades", "kilos", "facturacion_gs", "facturacion_dolar", "precio_prom_gs", "sku"],
    "BALANCEADOS": ["index", "fecha", "id_sucursal_bg", "unidades", "kilos", "facturacion_gs", "facturacion_dolar", "precio_prom_gs", "sku", "tipo_animal"],
    "CIGARRILLOS": ["index", "fecha", "id_sucursal_bg", "unidades", "cajas", "facturacion_gs", "facturacion_dolar", "precio_prom_gs", "sku"],
}
REQUIRED = ("fecha", "id_sucursal", "codigo de barras", "unidades vendidas", "total facturado")

WIDE = (
    "category", "period", "fecha", "id_sucursal_bg", "unidades", "paquetes", "fardos", "kilos",
    "cajas", "facturacion_gs", "facturacion_dolar", "precio_prom_gs", "sku", "tipo_animal",
)
REASONS = {
    "missing_product": "missing_product",
    "missing_store": "missing_store",
    "bad_units": "bad_units",
    "bad_amount": "bad_amount",
    "bad_pack": "bad_pack",
    "bad_date": "bad_date",
    "out_of_period": "out_of_period",
}


def enabled_categories() -> list[str]:
    return [name for name, on in CATEGORIES.items() if on]


def with_category(feed: DataFrame) -> DataFrame:
    """Add ``category``, the folder a feed file lies in."""
    return feed.withColumn("category", F.regexp_extract("source_file", r"([^/]+)/[^/]+$", 1))


def _number(df: DataFrame, column: str) -> Column:
    numeric = isinstance(df.schema[column].dataType, NumericType)
    return F.col(column).cast("double") if numeric else plain_number(F.col(column))


def tag_rows(
    feed: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    month: datetime.date | None = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """Every feed row of the given categories with its parsed values and what is wrong with it.

    The feed's cells are clean (``schema.clean_cells``, which ``read_feed`` applies).

    One pass over the feed serves the fact, the rejects and both review queues.
    ``month`` is the month the run loads; rows of other months are out of period.
    Product code and content come from the dimension; the code is compared in its
    canonical integer form, the store id as stripped text.
    """
    require_columns(feed, REQUIRED, "chain feed")
    rank = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.col("category"))
    code = F.col("`codigo de barras`")
    rows = computed(
        keep_enabled(feed, categories or list(CATEGORIES)),
        {
            "category_rank": rank,
            "product_key": integer_key(code),
            "units": plain_number(F.col("`unidades vendidas`")),
            "amount": plain_number(F.col("`total facturado`")),
            "day": day_month_year(F.col("fecha")),
        },
    )
    rows = rows.withColumn("codigo de barras", F.coalesce("product_key", code))
    known_stores = stores.select(strip(F.col("id_sucursal_bg").cast("string")).alias("store_key")).distinct()
    rows = with_key_flag(rows, _known_products(products), "product_key", "product_key", "has_product", dedup=False)
    rows = with_key_flag(rows, known_stores, "id_sucursal", "store_key", "has_store", dedup=False)

    other_month = F.lit(False) if month is None else month_start(F.col("day")) != F.lit(month.replace(day=1))
    return rows.withColumns(
        {
            "missing_product": ~F.col("has_product"),
            "missing_store": F.col("has_product") & ~F.col("has_store"),
            "bad_units": F.col("`unidades vendidas`").isNotNull() & F.col("units").isNull(),
            "bad_amount": F.col("`total facturado`").isNotNull() & F.col("amount").isNull(),
            "bad_pack": F.coalesce((F.col("category") == CIGARETTES) & F.col("pack_is_bad"), F.lit(False)),
            "bad_date": F.col("day").isNull(),
            "out_of_period": F.coalesce(other_month, F.lit(False)),
        }
    ).drop("pack_is_bad")


def _known_products(products: DataFrame) -> DataFrame:
    """One row per canonical code with its content and the number in its pack text."""
    stripped = strip_cells(
        products.select(F.col("ean").cast("string"), "gramaje", F.col("presentacion").cast("string").alias("pack"))
    )
    keyed = stripped.select(
        barcode_digits(F.col("ean")).alias("digits"), _number(stripped, "gramaje").alias("content"), "pack"
    ).filter("digits is not null")
    first = keep_first(
        keyed.select(without_leading_zeros(F.col("digits")).alias("product_key"), "content", "pack"), ["product_key"]
    )
    pack = F.col("pack")
    return first.withColumns({"pack_units": plain_number(pack), "pack_is_bad": is_bad_number(pack)})


CHECKED = ("unidades vendidas", "total facturado", "pack")


def first_bad_numbers(tagged: DataFrame, order_by: Sequence[str] = SOURCE_ORDER) -> dict[str, Column]:
    """Aggregates for the first units, amount and pack content that are no number, all in one pass."""
    where = ["fecha", "id_sucursal", "codigo de barras"]
    of_packs = F.col("category") == CIGARETTES
    return {
        c: quality.first_bad_number(tagged, c, where, order_by, of_packs if c == "pack" else F.lit(True)) for c in CHECKED
    }


def require_clean_numbers(tagged: DataFrame, found: Mapping[str, str | None]) -> None:
    """Strict mode: fail on the first bad number that ``first_bad_numbers`` found, the units' before the amount's."""
    for column in CHECKED:
        if found[column] is not None:
            rows = tagged.filter(F.col("category") == CIGARETTES) if column == "pack" else tagged
            raise ValueError(quality.bad_number_message(rows, column, found[column]))


def _wrong() -> Column:
    result = F.lit(False)
    for column in REASONS:
        result = result | F.col(column)
    return result


def fact_rows(tagged: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Valid rows as the wide fact of all categories, without the index."""
    measures = chain_measures(F.col("category"), F.col("units"), F.col("content"), F.col("pack_units"))
    values = measures | {
        "period": period(F.col("day")),
        "id_sucursal_bg": store_code(F.col("id_sucursal")),
        "facturacion_gs": F.col("amount"),
        "facturacion_dolar": dollars(F.col("amount")),
        "precio_prom_gs": F.lit(None).cast("double"),
        "sku": F.col("`codigo de barras`"),
        "tipo_animal": F.when(F.col("category") == "BALANCEADOS", column_or_null(tagged, "familia")),
        "category": F.col("category"),
        "fecha": F.col("day"),
    }
    extra = [F.col(quoted(c)) for c in order_by if c not in WIDE]
    return tagged.filter(~_wrong()).select(*[values[c].alias(c) for c in WIDE], *extra)


def fact(tagged: DataFrame, order_by: Sequence[str] = SOURCE_ORDER, stored: bool = False) -> DataFrame:
    """The wide fact with ``index`` 1..n per category and month, in file order."""
    numbered = load_index(fact_rows(tagged, order_by), order_by, ["category", "period"], stored)
    return numbered.select("index", *WIDE)


def category_fact(wide: DataFrame, category: str) -> DataFrame:
    """One category's rows in its own layout."""
    return wide.filter(F.col("category") == category).select(*LAYOUTS[category])


def rejects(tagged: DataFrame) -> DataFrame:
    """Rows not loaded, once per reason."""
    return rejects_by_reason(tagged.filter(_wrong()), REASONS)


def product_queue(tagged: DataFrame, layout: Sequence[str], order_by: Sequence[str | Column] = ()) -> DataFrame:
    return chain_product_queue(tagged.filter("missing_product"), layout, order_by)


def store_queue(tagged: DataFrame, layout: Sequence[str], order_by: Sequence[str | Column] = ()) -> DataFrame:
    return chain_store_queue(tagged.filter("missing_store"), layout, order_by)


def counters(tagged: DataFrame) -> DataFrame:
    return quality.run_counters(tagged, "codigo de barras", "id_sucursal")


def run_counts(wanted: Sequence[str]) -> dict[str, Column]:
    """The rows of each category by the step they got to, as aggregates of the tagged rows."""
    of = lambda category, *tests: F.count_if(reduce(and_, tests, F.col("category") == category))
    return {
        f"{measure}:{c}": of(c, *tests)
        for c in wanted
        for measure, tests in {
            "rows_in": (), "product_matched": (F.col("has_product"),),
            "store_matched": (F.col("has_product"), F.col("has_store")),
        }.items()
    }


COUNTERS = (
    "category string, rows_in bigint, product_matched bigint, store_matched bigint, product_keys_unmatched bigint, "
    "store_keys_unmatched bigint, outcome string, products_queued bigint, stores_queued bigint"
)


def counter_rows(
    counts: Mapping[str, int], wanted: Sequence[str], found: Sequence[str] | None, queued: tuple[int, int]
) -> list[tuple]:
    """A row of run counters for each wanted category, whether it had rows or a file or not.

    ``outcome`` is ``loaded``, or ``missing_file`` where no file was read: ``found`` names the
    categories with one, by default those with a row.
    """
    names = ("rows_in", "product_matched", "store_matched", "product_keys_unmatched", "store_keys_unmatched")
    result = []
    for c in wanted:
        values = [counts.get(f"{n}:{c}") or 0 for n in names]
        there = values[0] > 0 or (found is not None and c in found)
        result.append((c, *values, "loaded" if there else "missing_file", *queued))
    return result


def run(
    feed: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    month: datetime.date,
    out: str,
    product_layout: Sequence[str],
    store_layout: Sequence[str],
    categories: Sequence[str] | None = None,
    found: Sequence[str] | None = None,
    strict: bool = False,
    dry_run: bool = False,
) -> DataFrame:
    """Load one month of all categories into the store ``out``: fact, rejects and both queues.

    ``feed`` comes from ``read_feed`` and ``with_category``. The tagged rows are written
    once and every output reads them from there, once each; all counts are taken while writing.
    The month is replaced for each category whose file was read, also where no valid row came; a
    category without a file keeps what it has. ``found`` names the categories read
    (``selection.files_for_month``); by default they are those with a row in the feed. All four
    tables change together or, if the run stops, not at all (``operators.store``). Returns the
    run counters, a row for each category, with an ``outcome`` and the products and stores queued
    over all categories; the store keeps them too. A dry run writes nothing at all.
    """
    spark = feed.sparkSession
    wanted = list(categories or enabled_categories())
    tagged = tag_rows(feed, products, stores, month, wanted)
    if dry_run:
        rows = _dry_counts(tagged, (product_layout, store_layout), wanted, found, strict)
    else:
        with scratch_removed(spark):
            rows = _load(tagged, month, Store(spark, out), (product_layout, store_layout), wanted, found, strict)
    return spark.createDataFrame(rows, COUNTERS)


FIRST = ("category_rank", *SOURCE_ORDER)


def _dry_counts(
    tagged: DataFrame, layouts: tuple[Sequence[str], Sequence[str]], wanted: Sequence[str],
    found: Sequence[str] | None, strict: bool,
) -> list[tuple]:
    if strict:
        require_clean_numbers(tagged, tagged.agg(*[m.alias(n) for n, m in first_bad_numbers(tagged).items()]).first().asDict())
    counts = {f"{n}:{r.category}": v for r in counters(tagged).collect() for n, v in r.asDict().items() if n != "category"}
    queues = product_queue(tagged, layouts[0], FIRST), store_queue(tagged, layouts[1], FIRST)
    return counter_rows(counts, wanted, found, (queues[0].count(), queues[1].count()))


def _load(
    tagged: DataFrame,
    month: datetime.date,
    store: Store,
    layouts: tuple[Sequence[str], Sequence[str]],
    wanted: Sequence[str],
    found: Sequence[str] | None,
    strict: bool,
) -> list[tuple]:
    checks = first_bad_numbers(tagged) if strict else {}
    tagged, counts = written_counted(tagged, run_counts(wanted) | checks)
    if strict:
        require_clean_numbers(tagged, counts)
    load = store.load()
    present = [c for c in wanted if counts[f"rows_in:{c}"] or (found is not None and c in found)]
    gone = [{"category": c, "period": month.strftime("%Y-%m")} for c in present if found is None or c in found]
    load.put("fact", fact(tagged, stored=True), ["category", "period"], replaced=gone)
    load.put("rejects", rejects(tagged), ["reason"], replaced=[{"reason": r} for r in REASONS.values()])
    queued = []
    for name, key, measure, queue, layout in (
        ("product_queue", "codigo de barras", "product_keys_unmatched", chain_product_queue, layouts[0]),
        ("store_queue", "id_sucursal", "store_keys_unmatched", chain_store_queue, layouts[1]),
    ):
        # The first row of each key in each category: what is counted, and all the queue needs.
        missing = "missing_product" if name == "product_queue" else "missing_store"
        first = keep_first(tagged.filter(missing), ["category", key], FIRST)
        first, keys = written_counted(first, {f"{measure}:{c}": F.count_if(F.col("category") == c) for c in wanted})
        counts |= keys
        rows = load.put(name, queue(first, layout, FIRST), metrics={"n": F.count(F.lit(1))})
        queued.append(rows["n"])
    result = counter_rows(counts, wanted, found, tuple(queued))
    load.publish(run="chain", month=month.isoformat(), counters=result)
    return result


def run_day(
    spark: SparkSession,
    folder: str,
    day: datetime.date,
    products: str,
    stores: str,
    out: str,
    categories: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """From the run day to the loaded month: pick each category's file below ``folder``, read, ``run``.

    ``products`` and ``stores`` are paths of the dimension tables, whose columns are the queues'
    layouts. Categories without a file for the day's month are reported as ``missing_file``;
    ``options`` go to ``run``.
    """
    wanted = list(categories or enabled_categories())
    files = selection.best_files(selection.chain_candidates(selection.list_files(spark, folder)), "category")
    picked = selection.files_for_month(files, target_day(F.lit(day)), wanted).collect()
    paths, month = [r.path for r in picked if r.outcome == "found"], picked[0].period
    if not paths:
        return spark.createDataFrame(counter_rows({}, wanted, [], (0, 0)), COUNTERS)
    feed = with_category(read_feed(spark, paths, required=REQUIRED))
    layouts = [tables.read_dimension(spark, path).columns for path in (products, stores)]
    return run(
        feed, tables.read_chain_products(spark, products), tables.read_chain_stores(spark, stores), month, out, *layouts,
        categories=wanted, found=[r.category for r in picked if r.outcome == "found"], **options,
    )
