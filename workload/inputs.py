"""Feeds, dimensions and queues derived from the given tables.

Each input is one SELECT in the SQL both engines understand, so that a query and its
check start from the same rows. Every row of the tables takes part; gaps in the
dimensions come from business conditions (a brand not yet listed, a closed account).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")

# How each engine writes a number with grouped thousands and two places.
GROUPED = {"spark": "format_number({x}, 2)", "duckdb": "format('{{:,.2f}}', {x})"}

_MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)


def _month_name(day: str) -> str:
    cases = " ".join(f"when {i} then '{m}'" for i, m in enumerate(_MONTHS, start=1))
    return f"case month({day}) {cases} end"


def _two(number: str) -> str:
    return f"lpad(cast({number} as string), 2, '0')"


CATEGORY = """case l_returnflag || l_linestatus
    when 'AF' then 'YERBA' when 'AO' then 'VAPES' when 'NF' then 'PANALES'
    when 'NO' then 'CARAMELOS' when 'RF' then 'BALANCEADOS' else 'CIGARRILLOS' end"""

INPUTS = {
    "chain_feed": f"""
select {CATEGORY} as category,
  case when l_discount = 0.1 and l_tax = 0.08 then '31/02/' || cast(year(l_shipdate) as string)
       else {_two('day(l_shipdate)')} || '/' || {_two('month(l_shipdate)')} || '/' || cast(year(l_shipdate) as string)
  end as fecha,
  case l_linenumber when 1 then ' ' || cast(l_suppkey as string) || chr(160)
       else cast(l_suppkey as string) end as id_sucursal,
  'Sucursal ' || cast(l_suppkey as string) || ' ' || l_returnflag as sucursal,
  case l_linenumber
    when 2 then cast(l_partkey as string) || '.0'
    when 3 then '  ' || cast(l_partkey as string) || ' '
    when 4 then '00' || cast(l_partkey as string)
    when 5 then cast(l_partkey as string) || '0.0E-1'
    when 6 then case when l_tax = 0.0 then 'COD-' else '' end || cast(l_partkey as string)
    when 7 then chr(160) || cast(l_partkey as string)
    else cast(l_partkey as string) end as `codigo de barras`,
  'Articulo ' || cast(l_partkey as string) || ' ' || l_linestatus as descripcion,
  'Proveedor ' || cast(l_suppkey as string) as proveedor,
  case l_linenumber when 1 then 'PERRO' when 2 then 'GATO' when 3 then 'nan' else 'OTRO' end as familia,
  'Marca ' || cast(l_quantity as string) as marca,
  l_returnflag as clasificacion,
  cast(l_quantity as string) as gramaje,
  case when l_tax = 0.07 and l_discount = 0.0 then cast(l_quantity as string) || ' u'
       when l_tax = 0.06 and l_discount = 0.01 then 'nan'
       when l_tax = 0.05 and l_discount = 0.02 then '1d'
       else cast(l_quantity as string) end as `unidades vendidas`,
  case when l_tax = 0.04 and l_discount = 0.03 then 'sin dato'
       when l_tax = 0.03 and l_discount = 0.04 then ''
       else ' ' || cast(l_extendedprice as string) end as `total facturado` SOURCE
from lineitem""",
    "chain_products": """
select case p_type when 'PROMO' then cast(p_partkey as string) || '.0'
                   when 'SMALL' then '000' || cast(p_partkey as string)
                   when 'LARGE' then cast(p_partkey as string) || '00.0E-2'
                   when 'MEDIUM' then 'EAN ' || cast(p_partkey as string)
                   else cast(p_partkey as string) end as ean,
  cast(p_size as double) as gramaje,
  case when p_brand = 'Brand#7' then 'CAJA X ' || cast(p_size as string)
       else cast(p_size as string) end as presentacion,
  p_name as producto, p_brand as marca
from part where p_brand <> 'Brand#13'
union all
select cast(p_partkey as string), cast(p_size as double) + 1, 'REPETIDO', p_name, p_brand
from part where p_brand <> 'Brand#13' and p_size > 40""",
    "chain_stores": """
select ' ' || cast(s_suppkey as string) as id_sucursal_bg, s_name as nombre_local
from supplier where s_acctbal >= 0""",
    "panel_feed": f"""
select cast(year(l_shipdate) as string) as `ano de fecha`,
  case when l_discount = 0.1 and l_tax = 0.08 then ' febrero '
       when l_returnflag = 'R' then cast(month(l_shipdate) as string)
       when l_linestatus = 'O' and month(l_shipdate) = 9 then 'SETIEMBRE'
       else {_month_name('l_shipdate')} end as `mes de fecha`,
  case when l_discount = 0.1 and l_tax = 0.08 then '31' else cast(day(l_shipdate) as string) end as `dia de fecha`,
  case when o_orderpriority = '1-URGENT' and o_orderstatus = 'P' then '360845043'
       else cast(o_custkey as string) end as `codigo unico pdv`,
  case o_orderstatus when 'O' then ' Super  ' when 'F' then 'tienda' || chr(160) else 'Despensa ' end
    || 'Cliente ' || cast(o_custkey as string) as `nombre pdv`,
  'Cliente ' || cast(o_custkey as string) || ' S.A.' as `pdv_razon_social`,
  '80' || lpad(cast(o_custkey as string), 8, '0') as `pdv ruc`,
  case o_orderpriority when '1-URGENT' then ' Supermercado  grande' when '2-HIGH' then 'tienda de barrio'
       when '3-MEDIUM' then 'Mini despensa' when '5-LOW' then 'kiosco' end as `pdv clasif 3`,
  case o_orderstatus when 'P' then 'inactivo' else 'activo' end as `estado pdv`,
  'San   Lorenzo ' || o_orderstatus as `localidad pdv`,
  'calle ' || cast(o_custkey as string) as `direccion pdv`,
  cast(l_partkey as string) as `codigo barras sku`,
  'Articulo ' || cast(l_partkey as string) as `nombre sku`,
  'Marca ' || l_linestatus as `marca sku`,
  case l_returnflag || l_linestatus when 'AF' then 'cigarrillos' when 'AO' then ' Cigarrillos'
       when 'NF' then 'pañales' when 'NO' then 'bebidas  sin alcohol' when 'RF' then 'cerveza' else 'Yerba' end
    as `categoria sku`,
  'Proveedor ' || cast(l_suppkey as string) as `proveedor sku`,
  case l_linenumber when 1 then '20' when 2 then '1.500' when 3 then '0,5' when 4 then 'SURTIDO'
       when 5 then '' when 6 then '-3' else '900,7' end as `cant contenido sku`,
  'S' || cast(l_linenumber as string) as `prod clasif 3`,
  'SS' || cast(l_linenumber as string) as `prod clasif 4`,
  'var ' || l_returnflag as `prod clasif 5`,
  'esp ' || l_linestatus as `prod clasif 6`,
  'clas ' || l_returnflag as `prod clasif 7`,
  case l_linenumber when 1 then 'Gruesas' when 2 then 'cajetillas ' when 3 then 'GRUESAS' when 4 then 'CAJETILLAS' else 'otros' end
    as `prod clasif 10`,
  case l_returnflag when 'A' then 'menta' end as escencia,
  case l_linestatus when 'F' then 'frutal ' end as sabor,
  case when l_discount < 0.03 then '0' when l_discount < 0.05 then ''
       when l_discount < 0.07 then cast(l_extendedprice as string)
       else translate(GROUPED(l_extendedprice), ',.', '.,') end as `ventas en volumen`,
  case when l_tax = 0.02 then translate(GROUPED(l_quantity * 100), ',.', '.,')
       when l_tax = 0.01 then 's/d' else cast(cast(l_quantity as int) as string) end as `cantidad de venta`,
  translate(cast(l_extendedprice as string), '.', ',') as `precio por unidad`,
  translate(GROUPED(l_extendedprice), ',.', '.,') as `ventas en valor` SOURCE
from lineitem join orders on l_orderkey = o_orderkey""",
    "panel_products": """
select cast(p_partkey as string) as `Id_Producto`, p_name as `Descripcion_del_Producto`, p_brand as `Marca`,
  p_type as `Categoria`, cast(null as string) as `Segmento`, cast(null as string) as `Sub_Segmento`,
  cast(null as string) as `Variedades`, cast(p_size as string) || ' GR.' as `Presentacion_Producto`,
  cast(null as string) as `Proveedor`, 'OTROS' as `Propio_Otros`, cast(null as string) as especialidad,
  '-' as talle, 0 as unidades, cast(p_size as double) as `Gramos`, 'NO' as es_promo,
  cast(null as string) as `Empaque`, cast(null as string) as clasificacion
from part where p_brand <> 'Brand#13'""",
    "panel_stores": """
select cast(c_custkey as string) as `Id_Comercial`, c_name as `Nombre_PDV`, 'ACTIVO' as `Estado_PDV`,
  cast(null as string) as `Localidad_PDV`, cast(null as string) as `Direccion_PDV`,
  cast(null as string) as `RUC_PDV`, cast(null as string) as `Razon_Social_PDV`,
  c_mktsegment as `Pdv_Clasif_3`, '' as `Tipo_de_Comercio`
from customer where c_acctbal >= 0
union all
select '359545043', 'CORREGIDO', 'ACTIVO', null, null, null, null, null, ''""",
    # Some names are corrected for three segments only, some twice, some to a blank.
    "store_names": """
select 'super  cliente ' || cast(c_custkey as string) as `Nombre PDV`,
  ' cliente ' || cast(c_custkey as string) || ' s.a.' as `PDV_RAZON_SOCIAL`,
  'Supermercado ' || c_name || ' ' as `Nombre PDV Correcto`
from customer where c_mktsegment in ('BUILDING', 'MACHINERY', 'FURNITURE')
union all
select 'DESPENSA CLIENTE ' || cast(c_custkey as string), 'CLIENTE ' || cast(c_custkey as string) || ' S.A.',
  case when c_acctbal > 5000 then 'nan' else 'Almacen ' || c_name end
from customer
union all
select 'DESPENSA CLIENTE ' || cast(c_custkey as string), 'CLIENTE ' || cast(c_custkey as string) || ' S.A.',
  'Otro ' || c_name
from customer where c_mktsegment = 'BUILDING'""",
    "store_ids": """
select ' ' || cast(s_suppkey as string) as `ID sucursal nuevo`,
  case when s_acctbal < 0 then 'nan' else 'H' || cast(s_suppkey as string) || ' ' end as `Id Sucursal Viejo`,
  case when s_nationkey > 12 then '' else 'Local ' || s_name end as ` nombre`,
  s_suppkey as orden
from supplier where s_nationkey <= 18
union all
select cast(s_suppkey as string), 'Z' || cast(s_suppkey as string), 'Segunda ' || s_name, s_suppkey + 1000000000
from supplier where s_nationkey < 6""",
    "queue": """
select case when event_type = 'click' then cast(cast(floor(event_id / 2) as bigint) as string) || '.0'
            when event_type = 'view' then ' ' || cast(cast(floor(event_id / 2) as bigint) as string)
            when event_type = 'error' and value < 3 then ' '
            else cast(cast(floor(event_id / 2) as bigint) as string) end as clave,
  'Nombre ' || event_type as nombre, cast(user_id as string) || '.0' as codigo, event_id,
  case cast(floor(value * 100) as bigint) % 16
    when 0 then 'TRUE' when 1 then ' Sí ' when 2 then 'x' when 3 then 'no' when 4 then chr(160) || 'Si'
    when 5 then 't r u e' when 6 then 'FALSO' when 7 then 'Verdadero' when 8 then '1' when 9 then '0'
    when 10 then 'es verdadero' when 11 then 'yes' when 12 then '' when 13 then 'quizas' when 14 then 'Y'
    end as `Para Escritura`,
  value
from events""",
    "file_listing": f"""
select '/feeds/' || case o_orderstatus when 'F' then 'YERBA' when 'O' then 'VAPES' else 'PANALES' end || '/' ||
  case o_orderpriority
    when '1-URGENT' then cast(year(o_orderdate) as string) || '-' || {_month_name('o_orderdate')} || '.csv'
    when '2-HIGH' then {_month_name('o_orderdate')} || '-' || cast(year(o_orderdate) as string) || '.csv'
    when '3-MEDIUM' then upper({_month_name('o_orderdate')}) || '-' || cast(year(o_orderdate) as string) || '.CSV'
    when '4-NOT SPECIFIED' then 'ventas ' || replace({_month_name('o_orderdate')}, 'Septiembre', 'setiembre') || ' ' || cast(year(o_orderdate) as string) || ' v2.csv'
    else 'notas ' || cast(o_custkey as string) || '.txt' end as path,
  o_orderdate as modified, o_orderkey
from orders""",
    "panel_listing": f"""
select '/panel/' || cast(year(o_orderdate) as string) || '/' ||
  case o_orderpriority
    when '1-URGENT' then 'Base_' || {_month_name('o_orderdate')} || cast(year(o_orderdate) as string) || '.csv'
    when '2-HIGH' then 'base-' || lower({_month_name('o_orderdate')}) || '-' || cast(year(o_orderdate) as string) || '.csv'
    when '3-MEDIUM' then 'BASE ' || replace({_month_name('o_orderdate')}, 'Septiembre', 'Setiembre') || '_' || cast(year(o_orderdate) as string) || '.csv'
    when '4-NOT SPECIFIED' then 'base_final_' || {_month_name('o_orderdate')} || cast(year(o_orderdate) as string) || '.csv'
    else 'Resumen' || cast(year(o_orderdate) as string) || '.csv' end as path,
  o_orderdate as modified, o_orderkey
from orders""",
}


def input_sql(name: str, engine: str) -> str:
    """The SELECT of an input in one engine's spelling."""
    grouped = GROUPED[engine]
    sql = re.sub(r"GROUPED\(([^()]*)\)", lambda m: grouped.format(x=m.group(1)), INPUTS[name])
    # Spark adds where a lineitem row is stored, so that equal rows can be told apart.
    position = ", source_file, source_row" if engine == "spark" else ""
    sql = re.sub(r" SOURCE\b", position, sql)
    return sql if engine == "spark" else sql.replace("`", '"')


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input as a DataFrame."""
    sql = input_sql(name, "spark")
    used = [t for t in TABLES if re.search(rf"\b(from|join) {t}\b", sql)]
    for table in used:
        sql = re.sub(rf"\b(from|join) {table}\b", rf"\1 {{{table}}}", sql)
    return spark.sql(sql, **{t: _table(spark, sf_dir, t) for t in used})


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "lineitem":
        place = (F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("source_row"))
        table = table.select("*", *place)
    return spread(table) if name in ("lineitem", "orders", "events") else table


def spread(table: DataFrame) -> DataFrame:
    """Rows over all cores where the files are too few or small to be split that far.

    Large tables have more splits than cores and are left as they are.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def ctes(*names: str) -> str:
    """WITH clause body with the inputs, for DuckDB."""
    return ",\n".join(f"{n} as ({input_sql(n, 'duckdb')}\n)" for n in names)
