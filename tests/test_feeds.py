"""Files on disk: dialects, selection, both feeds end to end, sinks and promotion tables."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from gondola.operators import numbering, promotion, replace, sinks
from gondola.operators.store import Store
from gondola.plans import chain, panel
from gondola.session import shared_dir, written
from gondola.sources import feeds, selection, tables


def put(folder, name, content, modified=None):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(content)
    if modified:
        os.utime(path, (modified, modified))
    return path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dialects_and_cells(spark, tmp_path):
    paths = [
        put(tmp_path, "a b+1.csv", 'Fecha ;Código;Nota\n1; x ;"l1\nl2"\n2;nan;"dijo ""si"""\n'.encode()),
        put(tmp_path, "b.csv", "﻿Fecha,Código\n3,y\n".encode()),
        put(tmp_path, "c.csv", "Fecha,Código\n4,caña€\n".encode("cp1252")),
        put(tmp_path, "d.csv", "Fecha\tCódigo\n5,5\tzé\n6\tw\n".encode("utf-16")),
    ]
    got = feeds.read_feed(spark, paths, required=["fecha", "código"])
    assert rows(got.select("fecha", "código", "nota")) == [
        ("1", "x", "l1\nl2"), ("2", None, 'dijo "si"'), ("3", "y", None), ("4", "caña€", None), ("5,5", "zé", None), ("6", "w", None),
    ]
    kinds = {p[-5:]: (d.encoding, d.separator, d.multi_line) for p, d in feeds.detect_dialects(spark, paths, "panel").items()}
    assert kinds == {"1.csv": (feeds.BYTES, ",", True), "b.csv": (feeds.BYTES, ",", False), "c.csv": (feeds.BYTES, ",", False), "d.csv": ("UTF-16LE", "\t", False)}
    with pytest.raises(KeyError):
        feeds.read_feed(spark, paths[1:2], required=["total"])


def test_a_feed_is_read_once_and_only_when_it_is_used(spark, tmp_path):
    paths = [put(tmp_path, f"{i}.csv", f"a;b\n{i};caña\n".encode(e)) for i, e in enumerate(["utf-8", "cp1252", "utf-16"] * 3)]
    spark.sparkContext.setJobGroup("feed", "feed")
    try:
        got = feeds.read_feed(spark, [str(tmp_path)])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("feed")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(got.inputFiles()) == sorted(f"file://{p}" for p in paths)
    assert sorted(r.b or r["a;b"] for r in got.collect())[:1] and {r.b for r in got.collect() if r.b} == {"caña"}


def test_cells_of_one_file_in_two_encodings(spark, tmp_path):
    path = put(tmp_path, "m.csv", b"x,y\n" + "uno,ñandú\n".encode() + "dos,ñandú€\n".encode("cp1252") + b"tres\n,,\n")
    assert rows(feeds.read_feed(spark, [path]).select("x", "y")) == [("dos", "ñandú€"), ("tres", None), ("uno", "ñandú"), (None, None)]


def test_a_record_that_spans_lines_behind_the_first_bytes_is_no_silent_error(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(feeds, "HEAD", 64)
    path = put(tmp_path, "l.csv", ("a,b\n" + "1,2\n" * 100 + '3,"l1\nl2"\n').encode())
    with pytest.raises(Exception, match="multi_line=True"):
        feeds.read_feed(spark, [path]).collect()
    got = feeds.read_feed(spark, [path], multi_line=True)
    assert got.count() == 101 and got.filter("a = '3'").first().b == "l1\nl2"


@pytest.mark.parametrize("encoding, mark", [("utf-16-le", b"\xff\xfe"), ("utf-16-be", b"\xfe\xff"), ("utf-16-le", b"")])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_utf16_files_are_split_and_numbered_in_file_order(spark, tmp_path, encoding, mark, end):
    lines = ["Año\tNombre", *[f"{i}\tcañón Ċ{i}" for i in range(3000)]]
    path = put(tmp_path, "u.csv", mark + (end.join(lines) + end).encode(encoding))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        feed = feeds.read_feed(spark, [path], "panel")
        assert feed.rdd.getNumPartitions() > 3
        stored = written(feed)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = numbering.file_order(stored, bucket=100).orderBy("index").collect()
    assert [(r["index"], r.ano, r.nombre) for r in got] == [(i + 1, str(i), f"cañón Ċ{i}") for i in range(3000)]


def test_source_position_is_a_total_order_in_file_order(spark, tmp_path):
    body = "v\n" + "".join(f"{i}\n" for i in range(1000))
    path = put(tmp_path, "x.csv", body.encode())
    got = feeds.read_feed(spark, [path]).orderBy(*feeds.SOURCE_ORDER)
    assert [r.v for r in got.collect()] == [str(i) for i in range(1000)]


def test_panel_reader_drops_index_and_plain_headers(spark, tmp_path):
    path = put(tmp_path, "p.csv", "index\tAño  de Fecha\tPDV RUC\n0\t2024\t 5 \n".encode("utf-16"))
    got = feeds.read_feed(spark, [path], "panel")
    assert got.columns[:2] == ["ano de fecha", "pdv ruc"] and got.first()["pdv ruc"] == " 5 "


def test_chain_file_choice(spark, tmp_path):
    put(tmp_path, "YERBA/Mayo-2025.csv", b"x", 9_000)
    put(tmp_path, "YERBA/2025-Mayo.csv", b"x", 1_000)
    put(tmp_path, "VAPES/MAYO-2025.csv", b"x", 1_000)
    put(tmp_path, "VAPES/2025-mayo.csv", b"x", 5_000)
    put(tmp_path, "PANALES/ventas setiembre 2025.csv", b"x", 5_000)
    put(tmp_path, "PANALES/nota.txt", b"x")
    files = selection.list_files(spark, str(tmp_path))
    best = {(r.category, str(r.period)): r.path.split("/")[-1] for r in selection.best_files(selection.chain_candidates(files), "category").collect()}
    # The exact year-first name wins over a newer one; among equal names the newest does.
    assert best == {("YERBA", "2025-05-01"): "2025-Mayo.csv", ("VAPES", "2025-05-01"): "2025-mayo.csv"}
    loose = selection.best_files(selection.chain_candidates(files, loose=True), "category")
    assert ("PANALES", datetime.date(2025, 9, 1)) in {(r.category, r.period) for r in loose.collect()}


def test_panel_file_choice(spark, tmp_path):
    put(tmp_path, "a/Base_setiembre2025.csv", b"x", 1_000)
    put(tmp_path, "b/c/BASE-septiembre-2025.csv", b"x", 2_000)
    put(tmp_path, "b/base final septiembre2025.csv", b"x", 9_000)
    files = selection.list_files(spark, str(tmp_path))
    assert [r.name for r in selection.best_files(selection.panel_candidates(files)).collect()] == ["BASE-septiembre-2025.csv"]
    assert [r.name for r in selection.best_files(selection.panel_candidates(files, loose=True)).collect()] == ["Base_setiembre2025.csv"]


CHAIN = """fecha;id_sucursal;sucursal;codigo de barras;descripcion;proveedor;familia;marca;unidades vendidas;total facturado
05/03/1998;10;Diez;00111;Uno;P;F;M;2;7900
05/03/1998;10;Diez;111.0;Uno;P;F;M;3;15800
06/03/1998;99;Nueva;111;Uno;P;F;M;1;100
06/03/1998;10;Diez;222;Dos;P;F;M;1;100
06/03/1998;10;Diez;222;Dos bis;P;F;M;1;100
06/04/1998;10;Diez;111;Uno;P;F;M;1;100
06/03/1998;10;Diez;111;Uno;P;F;M;dos;100
31/02/1998;10;Diez;111;Uno;P;F;M;1;100
"""


@pytest.fixture
def chain_inputs(spark, tmp_path):
    yerba = put(tmp_path, "in/YERBA/1998-Marzo.csv", CHAIN.encode())
    packs = put(tmp_path, "in/PANALES/1998-Marzo.csv", CHAIN.encode("cp1252"))
    products = spark.createDataFrame([("111", 500.0, "20")], "ean string, gramaje double, presentacion string")
    stores = spark.createDataFrame([("10",)], "id_sucursal_bg string")
    feed = chain.with_category(feeds.read_feed(spark, [yerba, packs], required=chain.REQUIRED))
    return feed, products, stores, str(tmp_path / "out")


def put_month(old, out, category, month):
    load = Store(old.sparkSession, out).load()
    load.put("fact", old.withColumn("category", F.lit(category)).withColumn("period", F.lit(month)), ["category", "period"])
    load.publish()


LAYOUTS = (["producto", "ean", "categoria", "variedad"], ["id_sucursal_bg", "nombre_local", "ciudad"])


def test_chain_run(spark, chain_inputs):
    feed, products, stores, out = chain_inputs
    march = datetime.date(1998, 3, 1)
    old = spark.createDataFrame([(1, datetime.date(1998, 2, 1), 5.0)], "index int, fecha date, kilos double")
    old = old.select(F.col("index").cast("bigint"), "fecha", "kilos")
    for month in ("1998-02", "1998-03"):
        put_month(old, out, "YERBA", month)
    put_month(old, out, "VAPES", "1998-03")

    store = Store(spark, out)
    for _ in range(2):  # the second run changes nothing
        counted = chain.run(feed, products, stores, march, out, *LAYOUTS)
        fact = store.read("fact")
        yerba = fact.filter("category = 'YERBA' and period = '1998-03'").select("index", "sku", "unidades", "kilos", "facturacion_dolar")
        assert rows(yerba) == [(1, "111", 2.0, 1.0, 1.0), (2, "111", 3.0, 1.5, 2.0)]
        assert fact.filter("category = 'PANALES'").count() == 2
        assert fact.filter("period = '1998-02'").count() == 1  # other months stay
        assert fact.filter("category = 'VAPES'").count() == 1  # no VAPES file was read, so its month stays
    reasons = store.read("rejects").filter("category = 'YERBA'").groupBy("reason").count()
    assert dict(rows(reasons)) == {"missing_product": 2, "missing_store": 1, "bad_units": 1, "bad_date": 1, "out_of_period": 1}
    queue = store.read("product_queue").select("producto", "ean", "categoria", "para_escritura")
    assert rows(queue) == [("Dos", "222", "YERBA", False)]  # the first category and row win
    assert rows(store.read("store_queue").select("id_sucursal_bg", "nombre_local")) == [("99", "Nueva")]
    counts = {r.category: (r.rows_in, r.outcome, r.products_queued, r.stores_queued) for r in counted.collect()}
    loaded, absent = (8, "loaded", 1, 1), (0, "missing_file", 1, 1)
    assert counts == {"YERBA": loaded, "PANALES": loaded, "VAPES": absent, "CIGARRILLOS": absent}


def test_a_file_without_a_valid_row_empties_its_month(spark, chain_inputs):
    feed, products, stores, out = chain_inputs
    old = spark.createDataFrame([(1, datetime.date(1998, 3, 9))], "index bigint, fecha date")
    for category in ("VAPES", "CIGARRILLOS"):
        put_month(old, out, category, "1998-03")
    scratch = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    chain.run(feed, products, stores, datetime.date(1998, 3, 1), out, *LAYOUTS, found=["YERBA", "PANALES", "VAPES"])
    left = Store(spark, out).read("fact").groupBy("category").count()
    assert {r.category for r in left.collect()} == {"YERBA", "PANALES", "CIGARRILLOS"}
    assert set(os.listdir(scratch)) == before  # the run's scratch tables are gone


def test_chain_dry_run_writes_nothing_and_strict_stops(spark, chain_inputs):
    feed, products, stores, out = chain_inputs
    scratch = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    chain.run(feed, products, stores, datetime.date(1998, 3, 1), out, *LAYOUTS, dry_run=True)
    assert not os.path.exists(out) and set(os.listdir(scratch)) == before
    with pytest.raises(ValueError, match="dos"):
        chain.run(feed, products, stores, datetime.date(1998, 3, 1), out, *LAYOUTS, strict=True)


PANEL = (
    "Año de Fecha\tMes de Fecha\tDía de Fecha\tCódigo único PDV\tNombre PDV\tPDV_RAZON_SOCIAL\tPDV Clasif 3\tCódigo Barras SKU\tNombre SKU\t"
    "Categoría SKU\tCant Contenido SKU\tProd Clasif 10\tVentas en volumen\tCantidad de venta\tPrecio por unidad\tVentas en valor\n"
    "2025\tSetiembre\t3\t360845043\t super  uno\tUno SA\tSupermercado\t1\tA\tcigarrillos\t20\tGruesas\t\t2\t1.500\t3.000,5\n"
    "2025\tSeptiembre\t4\t7\tOtro\tX\tKiosco\t1\tA\tpañales\t30\t\t12,5\t1.000\t2,5\t2,5\n"
    "2025\tFebrero\t31\t7\tOtro\tX\tKiosco\t1\tA\tYerba\t30\t\t1\t1\t1\t1\n"
    "2025\tAgosto\t1\t8\tNuevo\tX\t\t9\tB\tcerveza\t900\t\t1\t1\t1\t1\n"
)


def test_panel_run(spark, tmp_path):
    path = put(tmp_path, "Base_septiembre2025.csv", PANEL.encode("utf-16"))
    names = put(tmp_path, "names.json", json.dumps([
        {"Nombre PDV": "Super uno", "PDV_RAZON_SOCIAL": "UNO SA ", "Nombre PDV Correcto": "Super Uno Central"},
        {"Nombre PDV": "otro", "PDV_RAZON_SOCIAL": "Y", "Nombre PDV Correcto": "No"},
    ]).encode())
    feed = feeds.read_feed(spark, [path], "panel")
    products = spark.createDataFrame([("1",)], "Id_Producto string")
    stores = spark.createDataFrame([("359545043",), ("7",)], "Id_Comercial string")
    mapping = tables.read_store_names(spark, names)
    out = str(tmp_path / "out")
    august = spark.createDataFrame([("old", datetime.date(2025, 8, 1), "2025-08")], "Id string, Fecha date, period string")
    store = Store(spark, out)
    load = store.load()
    load.put("fact", august, ["period"])
    load.publish()
    layout = ["Id_Producto", "Categoria", "Presentacion_Producto", "Gramos", "talle"]
    for _ in range(2):
        counts = panel.run(feed, products, stores, "S", out, layout, mapping, {"Marca": "M"})
        assert rows(counts) == [(4, 3, 3, 3, 1, 2, 1, 1)]
        fact = store.read("fact")
        assert rows(fact.filter("period = '2025-08'").select("Id")) == [("old",)]
        september = fact.filter("period = '2025-09'").orderBy("Id").collect()
        assert [(r.Id, r.Id_Comercial, r.Cantidad, r.Precio_Unitario, r.Facturacion_Gs, r.unidades) for r in september] == [
            ("0_S", "359545043", 2.0, 1500.0, 3000.5, 2), ("1_S", "7", 1000.0, 2.5, 2.5, 1000),
        ]
        assert [r.kilos for r in september] == [40.0, 12.5]
        assert september[0].cajas == 20 * 10.0 * 2 / 10000 and september[1].fardos == 12.5 * 30 / 1e6 / 0.00579
    reasons = store.read("rejects").select("Id", "reason")
    assert rows(reasons) == [("2_S", "bad_date"), ("3_S", "missing_product"), ("3_S", "missing_store")]
    assert rows(store.read("product_queue").drop("para_escritura")) == [("9", "CERVEZA", "900 ML.", 900.0, "-")]
    queue = store.read("store_queue")
    assert rows(queue.select("Código único PDV", "Nombre PDV")) == [("8", "NUEVO")]
    assert rows(panel.run(feed, products, stores, "S", str(tmp_path / "dry"), layout, mapping, dry_run=True)) == rows(counts)
    assert not os.path.exists(tmp_path / "dry")
    prepared = panel.prepare(feed, mapping)
    assert [r["nombre pdv"] for r in prepared.orderBy(*feeds.SOURCE_ORDER).collect()][:2] == ["Super Uno Central", "OTRO"]

    # The reviewed queue goes into the store dimension.
    dim = spark.createDataFrame([("7", "OTRO")], "Id_Comercial string, Nombre_PDV string")
    dim_path, queue_path = str(tmp_path / "dim"), str(tmp_path / "queue2")
    sinks.append_dimension(dim, dim_path)
    reviewed = queue.withColumn("para_escritura", F.lit("Sí"))
    promoted = promotion.promote(reviewed, tables.read_dimension(spark, dim_path), "Id_Comercial", "strict", promotion.PANEL_STORE_RENAMES)
    sinks.write_queue(promoted.remaining, queue_path)
    sinks.append_dimension(promoted.inserted, dim_path)
    assert rows(tables.read_dimension(spark, dim_path)) == [("7", "OTRO"), ("8", "NUEVO")]
    assert tables.read_queue(spark, queue_path).count() == 0
    assert rows(tables.existing_keys(tables.read_dimension(spark, dim_path), "Id_Comercial")) == [("7",), ("8",)]


def test_matched_rows_without_any_date_are_an_error(spark, tmp_path):
    path = put(tmp_path, "p.csv", "\n".join([PANEL.split("\n")[0], PANEL.split("\n")[3]]).encode("utf-16"))
    feed = feeds.read_feed(spark, [path], "panel")
    products = spark.createDataFrame([("1",)], "Id_Producto string")
    stores = spark.createDataFrame([("7",)], "Id_Comercial string")
    with pytest.raises(ValueError, match="date"):
        panel.run(feed, products, stores, "S", str(tmp_path / "out"), ["Id_Producto"])


def test_unusable_name_mapping_is_none(spark, tmp_path):
    assert tables.read_store_names(spark, str(tmp_path / "nothing.json")) is None
    assert tables.read_store_names(spark, put(tmp_path, "x.json", b'[{"a": 1}]')) is None


def test_replace_keeps_rows_without_a_date(spark):
    existing = spark.createDataFrame([(1, datetime.date(1998, 3, 1)), (2, None), (3, datetime.date(1998, 4, 1))], "i int, fecha date")
    new = spark.createDataFrame([(9, datetime.date(1998, 3, 9))], "i int, fecha date")
    start, end = replace.month_bounds(datetime.date(1998, 3, 31))
    once = replace.replace_month(existing, new, start, end)
    assert sorted(r.i for r in once.collect()) == [2, 3, 9]
    assert rows(replace.replace_month(once, new, start, end)) == rows(once)
    assert sorted(r.i for r in replace.replace_month(existing, new.limit(0), start, end).collect()) == [2, 3]
    found = replace.replace_periods_found(existing, new, "fecha")
    assert sorted(r.i for r in found.collect()) == [2, 3, 9]
    assert replace.month_bounds(datetime.date(2024, 12, 5)) == (datetime.date(2024, 12, 1), datetime.date(2025, 1, 1))


def test_scratch_tables_go_to_the_shared_folder(spark):
    kept = written(spark.range(3).toDF("a b"))
    assert rows(kept) == [(0,), (1,), (2,)]
    assert shared_dir(spark).removeprefix("file:") in kept.inputFiles()[0]


def queues(spark, root):
    store = Store(spark, root)
    load = store.load()
    load.put("products", spark.createDataFrame([("1", "uno")], "ean string, producto string"))
    rows_of = {"a": [("2", "dos", "si"), ("3", "tres", "no")], "b": [("2", "otra", "si"), ("4", "cuatro", "si")]}
    for name, content in rows_of.items():
        load.put(name, spark.createDataFrame(content, "ean string, producto string, para_escritura string"))
    load.publish()
    return store


def test_promotion_of_several_queues(spark, tmp_path):
    store = queues(spark, str(tmp_path / "store"))
    names = ["b", "a", "broken"]
    dry = promotion.run(store, names[:2], "products", "ean", dry_run=True)
    assert [tuple(r)[:3] for r in dry.collect()] == [("a", 1, 1), ("b", 2, 0)] and store.versions() == [1]
    first = promotion.run(store, names, "products", "ean")
    assert [tuple(r)[:3] for r in first.collect()] == [("a", 1, 1), ("b", 1, 0), ("broken", 0, None)]
    assert [r.error is None for r in first.collect()] == [True, True, False]
    assert promotion.last_promotion(store, "b")["inserted"] == 1 and promotion.last_promotion(store, "c") is None
    again = promotion.run(store, names, "products", "ean")
    assert [tuple(r)[:3] for r in again.collect()] == [("a", 0, 1), ("b", 0, 0), ("broken", 0, None)]
    assert rows(store.read("products")) == [("1", "uno"), ("2", "dos"), ("4", "cuatro")]


def test_file_for_the_run_day(spark):
    best = spark.createDataFrame([("YERBA", datetime.date(2025, 5, 1), "/y")], "category string, period date, path string")
    got = selection.files_for_month(best, F.lit(datetime.date(2025, 5, 31)), ["YERBA", "VAPES"])
    assert rows(got.select("category", "path", "outcome")) == [("VAPES", None, "missing"), ("YERBA", "/y", "found")]
    panel_file = selection.files_for_month(best.drop("category"), F.lit(datetime.date(2025, 5, 2)))
    assert rows(panel_file.select("path", "outcome")) == [("/y", "found")]


def test_chain_run_from_the_run_day(spark, tmp_path, chain_inputs):
    _, products, stores, out = chain_inputs
    products.write.parquet(str(tmp_path / "products"))
    stores.write.parquet(str(tmp_path / "stores"))
    put(tmp_path, "in/VAPES/1998-Marzo.csv", CHAIN.split("\n")[0].encode() + b"\n")
    tables_at = str(tmp_path / "products"), str(tmp_path / "stores")
    got = chain.run_day(spark, str(tmp_path / "in"), datetime.date(1998, 4, 1), *tables_at, out)
    counts = {r.category: (r.rows_in, r.outcome) for r in got.collect()}
    # The file of VAPES has a header and no row: it was read, and its month is empty now.
    assert counts == {"YERBA": (8, "loaded"), "PANALES": (8, "loaded"), "VAPES": (0, "loaded"), "CIGARRILLOS": (0, "missing_file")}
    nothing = chain.run_day(spark, str(tmp_path / "in"), datetime.date(1999, 4, 1), *tables_at, out)
    assert {r.outcome for r in nothing.collect()} == {"missing_file"} and Store(spark, out).versions() == [1]


def test_panel_run_from_the_run_day(spark, tmp_path):
    put(tmp_path, "in/Base_septiembre2025.csv", PANEL.encode("utf-16"))
    spark.createDataFrame([("1",)], "Id_Producto string").write.parquet(str(tmp_path / "p"))
    spark.createDataFrame([("7",)], "Id_Comercial string").write.parquet(str(tmp_path / "s"))
    args = str(tmp_path / "p"), str(tmp_path / "s"), "S", str(tmp_path / "out")
    got = panel.run_day(spark, str(tmp_path / "in"), datetime.date(2025, 10, 3), *args)
    assert got.first().rows_in == 4 and Store(spark, args[3]).info()["counters"]["loaded"] == got.first().loaded == 1
    assert panel.run_day(spark, str(tmp_path / "in"), datetime.date(2025, 9, 3), *args) is None
