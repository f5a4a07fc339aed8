"""The SQL each registered query is checked against, written from the definitions for DuckDB."""

from __future__ import annotations

from workload.inputs import ctes
from workload.queries import PANEL_PRODUCT_LAYOUT, PRODUCT_LAYOUT, STAMP, STORE_LAYOUT, WIDE_DOUBLE, WIDE_LONG

SPACE = r"[\s\x0b\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
SCIENTIFIC = r"[0-9]+(\.[0-9]+)?[eE][+-]?[0-9]{1,4}"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def present(x: str) -> str:
    return f"(case when lower({strip(x)}) not in ('', 'nan', 'none') then {x} end)"


def clean(x: str) -> str:
    return present(strip(x))


def upper_trim(x: str) -> str:
    return f"upper(regexp_replace({strip(x)}, '{SPACE}+', ' ', 'g'))"


def number(x: str) -> str:
    return f"(case when regexp_full_match({strip(x)}, '{NUMBER}') then try_cast({strip(x)} as double) end)"


def bad_number(x: str) -> str:
    return f"coalesce({present(strip(x))} is not null and not regexp_full_match({strip(x)}, '{NUMBER}'), false)"


def scientific(x: str) -> str:
    """Exact for the codes in use: decimal text moved by a power of ten, fraction cut."""
    mantissa = f"cast(regexp_extract({x}, '^[0-9.]+') as decimal(24, 4))"
    power = f"cast(regexp_extract({x}, '[eE]([+-]?[0-9]+)$', 1) as int)"
    return f"cast(cast(trunc({mantissa} * cast(power(10, {power}) as decimal(12, 4))) as hugeint) as varchar)"


def digits(x: str) -> str:
    s = strip(x)
    return f"""(case when regexp_full_match({s}, '{SCIENTIFIC}') then {scientific(s)}
      else nullif(regexp_replace(regexp_replace({s}, '\\.0$', ''), '[^0-9]', '', 'g'), '') end)"""


def key(x: str) -> str:
    s = strip(x)
    return f"""(case when regexp_full_match({s}, '{SCIENTIFIC}') then {scientific(s)}
      when regexp_full_match({s}, '[0-9]+(\\.0)?') then cast(cast(regexp_replace({s}, '\\.0$', '') as hugeint) as varchar) end)"""


def store(x: str) -> str:
    s = strip(x)
    return f"(case when regexp_full_match({s}, '[0-9]+') then cast(cast({s} as hugeint) as varchar) else {s} end)"


def or_zero(x: str) -> str:
    return f"""coalesce(try_cast(regexp_replace(
      case when contains({x}, '.') and contains({x}, ',') then replace(replace({x}, '.', ''), ',', '.')
           else replace({x}, ',', '.') end, '[^0-9.-]', '', 'g') as double), 0.0)"""


def thousands(x: str) -> str:
    s = f"regexp_replace(replace(replace({x}, '.', ''), ',', '.'), '{SPACE}', '', 'g')"
    return f"(case when regexp_full_match({s}, '{NUMBER}') then try_cast({s} as double) end)"


def safe(x: str) -> str:
    return f"regexp_replace({strip(x)}, '^([+-]?[0-9]+)\\.0$', '\\1')"


def dmy(x: str) -> str:
    return f"cast(try_strptime({strip(x)}, '%d/%m/%Y') as date)"


MONTH_NUMBER = {m: i for i, m in enumerate(
    "ENERO FEBRERO MARZO ABRIL MAYO JUNIO JULIO AGOSTO SEPTIEMBRE OCTUBRE NOVIEMBRE DICIEMBRE".split(), start=1
)} | {"SETIEMBRE": 9}


def month_number(x: str) -> str:
    cases = " ".join(f"when '{m}' then '{i}'" for m, i in MONTH_NUMBER.items())
    return f"(case upper({strip(x)}) {cases} else {x} end)"


def ymd(y: str, m: str, d: str) -> str:
    return f"cast(try_strptime({strip(y)} || '-' || {strip(m)} || '-' || {strip(d)}, '%Y-%m-%d') as date)"


def store_type(x: str) -> str:
    return f"""(case when upper({x}) like '%SUPERMERCADO%' then 'SUPERMERCADO' when upper({x}) like '%TIENDA%' then 'TIENDA'
      when upper({x}) like '%DESPENSA%' then 'DESPENSA' else '' end)"""


def presentation(content: str, category: str) -> str:
    n = f"replace({strip(content)}, ',', '.')"
    whole = f"cast(cast(trunc(cast({n} as double)) as bigint) as varchar)"
    return f"""(case when {present(content)} is null then '-'
      when regexp_full_match({n}, '{NUMBER}') then {whole} ||
        case when regexp_matches(upper(coalesce({category}, '')), 'BEBID|CAÑ|VINO|CERVE') then ' ML.' else ' GR.' end
      else {strip(content)} end)"""


def approved_text(x: str, mode: str) -> str:
    if mode == "strict":
        return f"coalesce(lower({strip(x)}) in ('true', '1', 'si', 'sí', 'yes', 'verdadero'), false)"
    w = f"regexp_replace(lower({x}), '{SPACE}', '', 'g')"
    return f"""coalesce(case when {w} in ('true', '1', 'yes', 'y', 'si', 'sí', 'x', 't', 'verdadero') then true
      when {w} in ('false', '0', 'no', 'n', 'f', 'falso') then false
      else contains({w}, 'true') or contains({w}, 'verdadero') end, false)"""


def least_key(columns: str, source: str, keys: str, order: str) -> str:
    """The first row per key."""
    ordered = ", ".join(f"{o} nulls first" for o in order.split(", "))
    return f"select {columns} from {source} qualify row_number() over (partition by {keys} order by {ordered}) = 1"


# ---- chain --------------------------------------------------------------------

CHAIN = f"""{ctes('chain_feed', 'chain_products', 'chain_stores')},
prod as (
  select code, min(struct_pack(g := content, p := pack)) as v
  from (select {key(digits('ean'))} as code, gramaje as content, presentacion as pack from chain_products)
  where code is not null group by code
),
tagged as (
  select category,
    list_position(['YERBA', 'VAPES', 'PANALES', 'CARAMELOS', 'BALANCEADOS', 'CIGARRILLOS'], category) as category_rank,
    {clean('fecha')} as fecha, {clean('sucursal')} as sucursal, {clean('id_sucursal')} as id_sucursal,
    coalesce({key('"codigo de barras"')}, {clean('"codigo de barras"')}) as codigo,
    {clean('descripcion')} as descripcion, {clean('proveedor')} as proveedor, {clean('familia')} as familia,
    {clean('marca')} as marca, {clean('clasificacion')} as clasificacion, {clean('gramaje')} as gramaje,
    {clean('"unidades vendidas"')} as uv, {clean('"total facturado"')} as tf,
    {number('"unidades vendidas"')} as units, {number('"total facturado"')} as amount,
    {dmy('fecha')} as day,
    prod.v.g as content, prod.v.p as pack,
    prod.code is not null as has_product,
    {strip('id_sucursal')} in (select {strip('id_sucursal_bg')} from chain_stores) as has_store,
    {bad_number('"unidades vendidas"')} as bad_units, {bad_number('"total facturado"')} as bad_amount,
    category = 'CIGARRILLOS' and {bad_number('prod.v.p')} as bad_pack
  from chain_feed left join prod on prod.code = {key('"codigo de barras"')}
),
fact as (
  select *, category = 'PANALES' as nappies, category = 'CIGARRILLOS' as cigarettes, strftime(day, '%Y-%m') as period
  from tagged
  where has_product and has_store and not bad_units and not bad_amount and not bad_pack and day is not null
),
wide as (
  select row_number() over (partition by category, period order by day nulls first, id_sucursal nulls first,
      codigo nulls first, units nulls first, amount nulls first, familia nulls first) as index,
    category, period, day as fecha, {store('id_sucursal')} as id_sucursal_bg,
    case when nappies then content * units else units end as unidades,
    case when nappies then units end as paquetes,
    case when nappies then content * units * (cast(30 as double) / 1000000 / cast(0.0058 as double)) end as fardos,
    case when not nappies and not cigarettes then content / 1000 * units end as kilos,
    case when cigarettes then {number('pack')} * units / 10000 end as cajas,
    amount as facturacion_gs, round_even(amount / 7900, 3) as facturacion_dolar,
    cast(null as double) as precio_prom_gs, codigo as sku,
    case when category = 'BALANCEADOS' then familia end as tipo_animal
  from fact
)"""

LAYOUTS = {
    "yerba": "unidades, kilos", "vapes": "unidades", "panales": "unidades, paquetes, fardos",
    "caramelos": "unidades, kilos", "balanceados": "unidades, kilos, tipo_animal", "cigarrillos": "unidades, cajas",
}


def _layout(names: tuple[str, ...], values: dict[str, str]) -> str:
    return ", ".join(f'{values.get(c, "cast(null as varchar)")} as "{c}"' for c in names)


_PRODUCT_VALUES = {
    "producto": "descripcion", "proveedor": "proveedor", "categoria": "category", "marca": "marca",
    "clasificacion": "clasificacion", "ean": "codigo", "gramaje": "gramaje",
}
_STORE_VALUES = {"id_sucursal_bg": "id_sucursal", "nombre_local": "sucursal"}

_SALES = f"""{ctes('chain_feed', 'chain_products')},
fact as (select {key('"codigo de barras"')} as codigo, marca, fecha from chain_feed),
raw as (select {key(digits('ean'))} as ean, gramaje, presentacion, marca as marca_dim from chain_products),
dim as ({least_key('*', 'raw', 'ean', 'ean, gramaje, presentacion, marca_dim')})"""

_JOINED = "select codigo, marca, fecha, ean, gramaje, presentacion, marca_dim from fact {} join dim on codigo = ean"

# ---- panel --------------------------------------------------------------------


def _col(name: str) -> str:
    return f'"{name}"'


_CLEANED = {
    "nombre pdv", "estado pdv", "localidad pdv", "direccion pdv", "pdv clasif 3", "categoria sku", "prod clasif 5",
    "prod clasif 6", "prod clasif 7", "prod clasif 10", "escencia", "sabor",
}
_PANEL_COLUMNS = (
    "ano de fecha", "dia de fecha", "nombre pdv", "pdv_razon_social", "pdv ruc", "pdv clasif 3", "estado pdv",
    "localidad pdv", "direccion pdv", "codigo barras sku", "nombre sku", "marca sku", "categoria sku", "proveedor sku",
    "cant contenido sku", "prod clasif 3", "prod clasif 4", "prod clasif 5", "prod clasif 6", "prod clasif 7",
    "prod clasif 10", "escencia", "sabor", "ventas en volumen", "cantidad de venta", "precio por unidad", "ventas en valor",
)


def _prepared_column(name: str) -> str:
    value = present(_col(name))
    return f"{upper_trim(value) if name in _CLEANED else value} as {_col(name)}"


PANEL = f"""{ctes('panel_feed', 'store_names', 'panel_products', 'panel_stores')},
cleaned as (
  select {', '.join(_prepared_column(c) for c in _PANEL_COLUMNS)},
    {month_number('"mes de fecha"')} as "mes de fecha",
    case "codigo unico pdv" when '360845043' then '359545043' else "codigo unico pdv" end as "codigo unico pdv"
  from panel_feed
),
parsed as (
  select *, {ymd('"ano de fecha"', '"mes de fecha"', '"dia de fecha"')} as fecha,
    {store_type('"pdv clasif 3"')} as tipo_de_comercio,
    {or_zero('"ventas en volumen"')} as sales, {or_zero('"cantidad de venta"')} as qty,
    {or_zero('"cant contenido sku"')} as content
  from cleaned
),
volumes as (select *, case when sales > 0 then sales else qty * content end as vol from parsed),
prepared as (
  select *, greatest(vol, 0.0) as kilos,
    case when "categoria sku" <> 'CIGARRILLOS' then 0.0
         when "prod clasif 10" = 'CAJETILLAS' then greatest(vol / 10000.0, 0.0)
         when "prod clasif 10" = 'GRUESAS'
         then greatest(content * (case when content = 20 then 10.0 else 20.0 end) * qty / 10000.0, 0.0)
         else 0.0 end as cajas,
    case when "categoria sku" = 'PAÑALES'
         then greatest(vol * cast(30 as double) / cast(1000000 as double) / cast(0.00579 as double), 0.0)
         else 0.0 end as fardos
  from volumes
),
fixes as (
  select upper({strip('"Nombre PDV"')}) as n, upper({strip('PDV_RAZON_SOCIAL')}) as r, min({clean('"Nombre PDV Correcto"')}) as fixed
  from store_names group by all having fixed is not null
),
candidates as (
  select fecha as "Fecha", "codigo unico pdv" as "Id_Comercial", "codigo barras sku" as "Id_Producto",
    {thousands('"cantidad de venta"')} as "Cantidad", {thousands('"precio por unidad"')} as "Precio_Unitario",
    {thousands('"ventas en valor"')} as "Facturacion_Gs", kilos, cajas, fardos
  from prepared
),
numbered as (
  select *, cast(row_number() over (order by "Fecha" nulls first, "Id_Comercial" nulls first, "Id_Producto" nulls first,
      "Cantidad" nulls first, "Precio_Unitario" nulls first, "Facturacion_Gs" nulls first, kilos nulls first,
      cajas nulls first, fardos nulls first) - 1 as varchar) || '_{STAMP}' as "Id",
    "Id_Producto" in (select "Id_Producto" from panel_products) as has_product,
    "Id_Comercial" in (select "Id_Comercial" from panel_stores) as has_store
  from candidates
)"""

_PANEL_PRODUCT_VALUES = {
    "Id_Producto": _col("codigo barras sku"), "Descripcion_del_Producto": _col("nombre sku"),
    "Marca": _col("marca sku"), "Categoria": _col("categoria sku"), "Segmento": _col("prod clasif 3"),
    "Sub_Segmento": _col("prod clasif 4"), "Variedades": _col("prod clasif 5"),
    "Presentacion_Producto": presentation(_col("cant contenido sku"), _col("categoria sku")),
    "Proveedor": _col("proveedor sku"), "Propio_Otros": "'OTROS'", "especialidad": _col("prod clasif 6"),
    "talle": "'-'", "unidades": "0", "Gramos": thousands(_col("cant contenido sku")), "es_promo": "'NO'",
    "Empaque": _col("prod clasif 10"), "clasificacion": _col("prod clasif 7"),
}
_NAMES = f"""{ctes('panel_feed', 'store_names')},
rows_in as (select "codigo unico pdv", {upper_trim('"nombre pdv"')} as "nombre pdv", pdv_razon_social from panel_feed),
known as (
  select upper({strip('"Nombre PDV"')}) as n, upper({strip('PDV_RAZON_SOCIAL')}) as r, {clean('"Nombre PDV Correcto"')} as fixed
  from store_names where {clean('"Nombre PDV Correcto"')} is not null
)"""

_STORE_DIM = """select distinct "codigo unico pdv" as "Id_Comercial", "nombre pdv" as "Nombre_PDV", "estado pdv" as "Estado_PDV",
  "localidad pdv" as "Localidad_PDV", "direccion pdv" as "Direccion_PDV", "pdv ruc" as "RUC_PDV",
  pdv_razon_social as "Razon_Social_PDV", "pdv clasif 3" as "Pdv_Clasif_3", tipo_de_comercio as "Tipo_de_Comercio"
from prepared where "codigo unico pdv" <> ''"""

# ---- promotion ----------------------------------------------------------------


def _promoted(dim: str, dim_sql: str, columns: dict[str, str], extra: str, mode: str, key_name: str) -> str:
    """Dimension after promotion; ``columns`` maps its columns to queue expressions."""
    listed = ", ".join(f'{v} as "{c}"' for c, v in columns.items())
    names = ", ".join(f'"{c}"' for c in columns)
    order = ", ".join(f'"{c}"' for c in columns if c != key_name)
    return f"""with {ctes('queue', dim)},
dim as ({dim_sql}),
ready as (
  select {listed} from queue
  where {approved_text('"Para Escritura"', mode)} and {safe('clave')} <> ''
),
fresh as ({least_key('*', f'(select * from ready where "{key_name}" not in (select "{key_name}" from dim))', f'"{key_name}"', order)})
select {names}{extra} from dim union all select {names}{extra.replace('talle', 'null')} from fresh"""


# ---- files --------------------------------------------------------------------

_MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre setiembre octubre noviembre diciembre".split()
_ANY = "|".join(_MONTHS)
_PROPER = "|".join(m.title() for m in _MONTHS if m != "setiembre")


def _files(listing: str) -> str:
    return f"""with {ctes(listing)},
files as (
  select path, max(modified) as modified, regexp_extract(path, '[^/]+$') as name,
    regexp_extract(path, '([^/]+)/[^/]+$', 1) as folder
  from {listing} group by path
),
months(month_name, month_no) as (values {', '.join(f"('{m}', {MONTH_NUMBER[m.upper()]})" for m in _MONTHS)}),
years(y) as (select distinct year(o_orderdate) from orders),
found as (
  select distinct path, modified, name, lower(name) as low, folder, y, month_no from files, months, years
  where contains(lower(name), month_name) and contains(name, cast(y as varchar))
)"""


def _newest(by: str, quality: str, listing: str) -> str:
    keys = f"{by}, period" if by else "period"
    columns = f"{by}, " if by else ""
    return f"""{_files(listing)},
ranked as (select folder as category, make_date(cast(y as int), month_no, 1) as period, path, modified, {quality} as quality from found)
select {columns}period, path, modified, cast(quality as int) as quality from ranked where quality is not null
qualify row_number() over (partition by {keys} order by quality, modified desc, path) = 1"""


_CHAIN_QUALITY = f"""case when regexp_full_match(name, '[0-9]{{4}}-({_PROPER})\\.csv') then 1
  when regexp_full_match(name, '({_PROPER})-[0-9]{{4}}\\.csv') then 2
  when regexp_full_match(low, '[0-9]{{4}}-({_ANY})\\.csv|({_ANY})-[0-9]{{4}}\\.csv') then 3"""
_PANEL_QUALITY = f"case when regexp_full_match(low, 'base[ _-]?({_ANY})[ _-]?[0-9]{{4}}\\.csv') then 1 end"
_PANEL_LOOSE = f"""case when regexp_full_match(low, 'base_({_ANY})[_-]?[0-9]{{4}}\\.csv')
  then case when regexp_matches(low, '_[0-9]{{4}}\\.csv') then 3 when regexp_matches(low, '-[0-9]{{4}}\\.csv') then 2 else 1 end
    + case when contains(low, 'setiembre') then 3 else 0 end
  when low like 'base\\_%' escape '\\' then 7 end"""

# ---- profile ------------------------------------------------------------------


def _profile(group: str) -> str:
    shown = f"{group}, " if group else ""
    grouped = f"group by {group}" if group else ""
    return f"""with {ctes('panel_feed')},
v as (select upper(trim("categoria sku")) as kind, {or_zero('"ventas en volumen"')} as x from panel_feed),
m as (
  select {shown}count(*) as n, avg(x) as mean, stddev_samp(x) as std, min(x) as lo, max(x) as hi, quantile_cont(x, 0.25) as q25, quantile_cont(x, 0.5) as q50, quantile_cont(x, 0.75) as q75
  from v {grouped}
)
select {shown}n, round(mean, 4) as mean, round(std, 4) as std, lo as min,
  round(q25, 4) as q25, round(q50, 4) as q50, round(q75, 4) as q75, hi as max from m"""


_REMAP = f"""{ctes('chain_feed', 'store_ids')},
ids as (select {clean('"ID sucursal nuevo"')} as new, {clean('"Id Sucursal Viejo"')} as old, {clean('" nombre"')} as name, orden from store_ids),
mapping as (
  select new, old, name from ids where new is not null and old is not null
  qualify row_number() over (partition by new order by orden desc) = 1
),
remapped as (
  select coalesce(m.old, f.id) as id_sucursal, coalesce(m.name, f.sucursal) as nombre_local, fecha, m.new is not null as remapped
  from (select *, {strip('id_sucursal')} as id from chain_feed) f left join mapping m on f.id = m.new
)"""

_EXISTING = """select o_orderkey as id, case when o_orderpriority <> '5-LOW' then cast(o_orderdate as date) end as fecha,
  o_totalprice as monto from orders"""
_LINES = "select l_orderkey as id, cast(l_shipdate as date) as fecha, l_extendedprice as monto from lineitem"


def _reject(reason: str, condition: str, source: str, columns: str) -> str:
    return f"select {columns}, '{reason}' as reason from {source} where {condition}"


def oracle() -> dict[str, str]:
    sql = {"chain_fact": f"with {CHAIN} select * from wide"}
    for category, names in LAYOUTS.items():
        sql[f"chain_fact_{category}"] = (
            f"with {CHAIN} select index, fecha, id_sucursal_bg, {names}, facturacion_gs, facturacion_dolar, "
            f"precio_prom_gs, sku from wide where category = '{category.upper()}'"
        )
    columns = 'category, fecha, id_sucursal, codigo, uv as "unidades vendidas", tf as "total facturado"'
    sql["chain_rejects"] = f"with {CHAIN} " + " union all ".join(
        _reject(reason, condition, "tagged", columns)
        for reason, condition in {
            "missing_product": "not has_product",
            "missing_store": "has_product and not has_store",
            "bad_units": "bad_units",
            "bad_amount": "bad_amount",
            "bad_pack": "bad_pack",
            "bad_date": "day is null",
            "out_of_period": "not (day >= date '1998-03-01' and day < date '1998-04-01')",
        }.items()
    )
    sql["chain_enabled_categories"] = f"""with {ctes('chain_feed')} select category, count(*) as n from chain_feed
      where category in ('YERBA', 'VAPES', 'PANALES', 'CIGARRILLOS') group by category"""
    product_order = "category_rank, descripcion, proveedor, category, marca, clasificacion, codigo, gramaje"
    first = least_key("*", "tagged where not has_product", "codigo", product_order)
    sql["chain_product_queue"] = f"""with {CHAIN} select {_layout(PRODUCT_LAYOUT, _PRODUCT_VALUES)}, false as para_escritura
      from ({first})"""
    first = least_key("*", "tagged where has_product and not has_store", "id_sucursal", "category_rank, id_sucursal, sucursal")
    sql["chain_store_queue"] = f"""with {CHAIN} select {_layout(STORE_LAYOUT, _STORE_VALUES)}, false as para_escritura
      from ({first})"""
    sql["run_counters"] = f"""with {CHAIN} select category, count(*) as rows_in,
      count(*) filter (has_product) as product_matched,
      count(*) filter (has_product and has_store) as store_matched,
      count(distinct codigo) filter (not has_product) as product_keys_unmatched,
      count(distinct id_sucursal) filter (has_product and not has_store) as store_keys_unmatched
      from tagged group by category"""
    sql["load_row_index"] = f"""with {ctes('chain_feed')}, d as (
        select category, {dmy('fecha')} as day, strftime({dmy('fecha')}, '%Y-%m') as period, sucursal, descripcion from chain_feed)
      select *, row_number() over (partition by category, period order by day nulls first, sucursal, descripcion) as index from d"""

    sql["validated_join_inner"] = f"with {_SALES} {_JOINED.format('inner')}"
    sql["validated_join_left"] = f"with {_SALES} {_JOINED.format('left')}"
    sql["validated_join_right"] = f"with {_SALES} {_JOINED.format('right')}"
    sql["validated_join_outer"] = f"with {_SALES} {_JOINED.format('full')}"
    sql["join_provenance"] = f"""with {_SALES}, j as (
        select codigo, ean, case when d.there is null then 'left_only' when f.here is null then 'right_only' else 'both' end as origin
        from (select codigo, true as here from fact) f full join (select ean, true as there from dim) d on codigo = ean)
      select origin, cast(length(coalesce(codigo, ean)) as int) as digits, count(*) as n from j group by all"""
    sql["unmatched_products"] = f"with {_SALES} " + least_key(
        "*", "fact where codigo is null or codigo not in (select ean from dim where ean is not null)", "codigo", "codigo, marca, fecha"
    )
    sql["key_validation_flags"] = f"""with {ctes('panel_feed', 'panel_products', 'panel_stores')}
      select "codigo unico pdv" as "Id_Comercial", "codigo barras sku" in (select "Id_Producto" from panel_products) as has_product,
        "codigo unico pdv" in (select "Id_Comercial" from panel_stores) as has_store, count(*) as n
      from panel_feed group by all"""
    sql["store_id_mapping"] = f"""with {_REMAP} select new as id_sucursal_nuevo, old as id_sucursal_viejo, name as nombre from mapping"""
    sql["store_id_remap"] = f"with {_REMAP} select * from remapped"
    sql["store_id_remap_count"] = f"with {_REMAP} select count(*) filter (remapped) as remapped_rows, count(*) as rows from remapped"
    sql["store_name_fix"] = f"""with {_NAMES}, f as (select n, r, min(fixed) as fixed from known group by n, r)
      select "codigo unico pdv", {strip('coalesce(fixed, "nombre pdv")')} as "nombre pdv", pdv_razon_social
      from rows_in left join f on n = upper({strip('"nombre pdv"')}) and r = upper({strip('pdv_razon_social')})"""
    sql["store_name_fix_by_name"] = f"""with {_NAMES}, f as (select n, min(fixed) as fixed from known group by n)
      select "codigo unico pdv", {strip('coalesce(fixed, "nombre pdv")')} as "nombre pdv"
      from rows_in left join f on n = upper({strip('"nombre pdv"')})"""
    dim_columns = '"Direccion_PDV", "Estado_PDV", "Id_Comercial", "Localidad_PDV", "Nombre_PDV", "Pdv_Clasif_3", "RUC_PDV", "Razon_Social_PDV", "Tipo_de_Comercio"'
    fresh = least_key(
        dim_columns, f'({_STORE_DIM}) d where "Id_Comercial" not in (select "Id_Comercial" from panel_stores)', '"Id_Comercial"', dim_columns
    )
    sql["insert_if_absent"] = f"with {PANEL} select {dim_columns} from panel_stores union all ({fresh})"

    sql["canonical_product_key"] = f"""with {ctes('chain_feed', 'chain_products')},
      codes as (select "codigo de barras" as codigo from chain_feed union all select ean from chain_products)
      select codigo, {digits('codigo')} as digits, {key('codigo')} as key, {store('codigo')} as as_store from codes"""
    numbers = ["cant contenido sku", "ventas en volumen", "cantidad de venta", "precio por unidad", "ventas en valor"]
    parsed = ", ".join(f"{_col(c)}, {or_zero(_col(c))} as zero_{i}, {thousands(_col(c))} as thousands_{i}" for i, c in enumerate(numbers))
    sql["spanish_numbers"] = f"with {ctes('panel_feed')} select {parsed} from panel_feed"
    name, content = _col("nombre pdv"), _col("cant contenido sku")
    sql["text_cleanup"] = f"""with {ctes('panel_feed')} select {name} as nombre, {strip(name)} as stripped, {upper_trim(name)} as upper_name,
      upper({strip(name)}) as key, strip_accents("categoria sku") as plain_kind, {upper_trim('"localidad pdv"')} as upper_place,
      {safe(content)} as safe_content, {present(content)} as content, cast(trunc({number(content)}) as bigint) as whole_content
      from panel_feed"""
    sql["code_and_month_substitution"] = f"""with {ctes('panel_feed')} select "codigo unico pdv", "mes de fecha",
      replace("codigo unico pdv", '360845043', '359545043') as code, {month_number('"mes de fecha"')} as month from panel_feed"""
    sql["store_type"] = f"""with {ctes('panel_feed')} select "pdv clasif 3", {store_type('"pdv clasif 3"')} as tipo_de_comercio, count(*) as n
      from panel_feed group by all"""
    sql["presentation_texts"] = f"""with {ctes('panel_feed')} select "cant contenido sku", "categoria sku",
      {presentation(content, '"categoria sku"')} as presentacion, count(*) as n from panel_feed group by all"""
    names = " ".join(f"when {i} then '{m.title()}'" for m, i in MONTH_NUMBER.items() if m != "SETIEMBRE")
    sql["date_rules"] = f"""with {PANEL}, d as (select fecha as day from prepared)
      select day, cast(date_trunc('month', day) as date) as month_start,
        cast(date_trunc('month', day) + interval 1 month as date) as next_start,
        cast(date_trunc('month', day) - interval 1 month as date) as previous_start,
        case when day(day) = 1 then cast(day - interval 1 day as date) else day end as target,
        case month(day) {names} end as month_name, strftime(day, '%Y-%m') as period, day as again from d"""
    sql["chain_dates"] = f"with {ctes('chain_feed')} select fecha, {dmy('fecha')} as day, count(*) as n from chain_feed group by all"
    for mode in ("lenient", "strict"):
        by_number = "abs(value - 5) >= 1" if mode == "lenient" else "value - 5 <> 0"
        sql[f"flag_parse_{mode}"] = f"""with {ctes('queue')} select event_id, "Para Escritura" as flag,
          {approved_text('"Para Escritura"', mode)} as by_text, coalesce({by_number}, false) as by_number from queue"""
    sql["flag_values"] = f'with {ctes("queue")} select distinct "Para Escritura" from queue'

    sql["panel_fact"] = f"""with {PANEL} select "Id", "Fecha", "Id_Comercial", "Id_Producto", "Cantidad", "Precio_Unitario",
      "Facturacion_Gs", try_cast(trunc("Cantidad") as bigint) as unidades, least(cajas, 1000000.0) as cajas,
      least(fardos, 1000000.0) as fardos, least(kilos, 1000000.0) as kilos
      from numbered where has_product and has_store and "Fecha" is not null"""
    columns = '"Id", "Fecha", "Id_Comercial", "Id_Producto"'
    sql["rejects_by_reason"] = f"with {PANEL} " + " union all ".join(
        _reject(reason, condition, "numbered", columns)
        for reason, condition in {
            "missing_product": "not has_product", "missing_store": "not has_store", "bad_date": '"Fecha" is null',
        }.items()
    )
    sql["panel_run_counters"] = f"""with {PANEL},
      seen as (select coalesce(has_product, false) as p, coalesce(has_store, false) as s, "Fecha" from numbered)
      select count(*) as rows_in, count_if(p) as product_matched, count_if(s) as store_matched, count_if(p and s) as matched,
        count_if("Fecha" is null) as bad_date, count_if(p and s and "Fecha" is not null) as loaded,
        (select count(distinct "codigo barras sku") from prepared
         where "codigo barras sku" not in (select "Id_Producto" from panel_products)) as products_queued,
        (select count(distinct "codigo unico pdv") from prepared
         where "codigo unico pdv" not in (select "Id_Comercial" from panel_stores)) as stores_queued
      from seen"""
    sql["run_row_id"] = f"with {PANEL} select {columns} from numbered"
    bounded = ", ".join(f"least({c} * 10000, 1000000.0) as {c}_bounded" for c in ("kilos", "cajas", "fardos"))
    sql["panel_measures"] = f"""with {PANEL} select "categoria sku", "prod clasif 10", fecha, tipo_de_comercio, kilos, cajas, fardos, {bounded}
      from prepared"""
    order = ", ".join(
        _col(c) for c in (
            "nombre sku", "marca sku", "categoria sku", "proveedor sku", "prod clasif 3", "prod clasif 4",
            "prod clasif 5", "prod clasif 6", "prod clasif 7", "prod clasif 10", "cant contenido sku",
        )
    )
    first = least_key(
        "*", 'prepared where "codigo barras sku" not in (select "Id_Producto" from panel_products)', '"codigo barras sku"', order
    )
    sql["panel_product_queue"] = f"""with {PANEL} select false as para_escritura, {_layout(PANEL_PRODUCT_LAYOUT, _PANEL_PRODUCT_VALUES)}
      from ({first})"""
    order = ", ".join(
        _col(c) for c in ("nombre pdv", "pdv clasif 3", "pdv ruc", "pdv_razon_social", "estado pdv", "localidad pdv", "direccion pdv")
    )
    first = least_key(
        "*", 'prepared where "codigo unico pdv" not in (select "Id_Comercial" from panel_stores)', '"codigo unico pdv"', order
    )
    sql["panel_store_queue"] = f"""with {PANEL} select false as para_escritura, "codigo unico pdv" as "Código único PDV",
      "pdv clasif 3" as "Pdv Clasif 3", "pdv ruc" as "Pdv RUC", pdv_razon_social as "PDV_RAZON_SOCIAL",
      "nombre pdv" as "Nombre PDV", "estado pdv" as "Estado PDV", "localidad pdv" as "Localidad PDV", "direccion pdv" as "Dirección PDV"
      from ({first})"""
    sql["product_dimension_from_feed"] = f"""with {PANEL} select distinct "codigo barras sku" as "Id_Producto", "categoria sku" as "Categoria_SKU",
      cast(trunc({number(content)}) as bigint) as "Cant_Contenido_SKU", escencia as "Escencia", sabor as "Sabor",
      "prod clasif 3", "prod clasif 4", "prod clasif 5", "prod clasif 6", "prod clasif 7", "prod clasif 10"
      from (select distinct "codigo barras sku", "categoria sku", "cant contenido sku", escencia, sabor, "prod clasif 3", "prod clasif 4",
        "prod clasif 5", "prod clasif 6", "prod clasif 7", "prod clasif 10" from prepared)"""
    sql["store_dimension_from_feed"] = f"with {PANEL} {_STORE_DIM}"

    clave, nombre, codigo = safe("clave"), safe("nombre"), safe("codigo")
    sql["promote_chain_products"] = _promoted(
        "chain_products", f"select {key(digits('ean'))} as ean, producto, presentacion as gramaje from chain_products",
        {"ean": clave, "producto": nombre, "gramaje": codigo}, "", "lenient", "ean",
    )
    sql["promote_chain_stores"] = _promoted(
        "chain_stores", f"select {strip('id_sucursal_bg')} as id_sucursal_bg, nombre_local from chain_stores",
        {"id_sucursal_bg": clave, "nombre_local": nombre}, "", "lenient", "id_sucursal_bg",
    )
    sql["promote_panel_products"] = _promoted(
        "panel_products", 'select "Id_Producto", "Marca", "Gramos", talle from panel_products',
        {"Id_Producto": clave, "Marca": nombre, "Gramos": f"cast({codigo} as double)"}, ", talle", "strict", "Id_Producto",
    )
    sql["promote_panel_stores"] = _promoted(
        "panel_stores", 'select "Id_Comercial", "Nombre_PDV", "RUC_PDV" from panel_stores',
        {"Id_Comercial": clave, "Nombre_PDV": nombre, "RUC_PDV": codigo}, "", "strict", "Id_Comercial",
    )
    flag = approved_text('"Para Escritura"', "lenient")
    sql["queue_remaining"] = f"""with {ctes('queue')} select clave as ean, nombre as producto, codigo as gramaje, event_id, {flag} as para_escritura
      from queue where not ({flag} and {safe('clave')} <> '')"""
    dims = {"chain_products": ("chain_products", "lenient"), "chain_stores": ("chain_stores", "lenient"),
            "panel_products": ("panel_products", "strict"), "panel_stores": ("panel_stores", "strict")}
    sql["promotion_counters"] = " union all ".join(
        f"""select (select count(*) from ({sql['promote_' + entity]})) - (select count(*) from (with {ctes(dim)} select * from {dim})) as inserted,
          (select count(*) from (with {ctes('queue')} select * from queue where not ({approved_text('"Para Escritura"', mode)} and {safe('clave')} <> ''))) as remaining,
          '{entity}' as queue"""
        for entity, (dim, mode) in dims.items()
    )
    sql["queue_split"] = f"""with {ctes('queue')} select case when {flag} then 'approved' else 'pending' end as part,
      {flag} as para_escritura, count(*) as n from queue group by all"""

    sql["replace_month"] = f"""select * from ({_EXISTING}) where fecha is null or fecha < date '1998-03-01' or fecha >= date '1998-04-01'
      union all select * from ({_LINES}) where fecha >= date '1998-03-01' and fecha < date '1998-04-01'"""
    sql["replace_periods_found"] = f"""with old as (select * replace (cast(fecha - interval 12 month as date) as fecha) from ({_EXISTING}))
      select * from old where fecha is null or strftime(fecha, '%Y%m') not in (select strftime(fecha, '%Y%m') from ({_LINES}) where fecha is not null)
      union all select * from ({_LINES})"""
    sql["periods_in_batch"] = f"select distinct cast(date_trunc('month', fecha) as date) as period from ({_LINES})"

    sql["newest_chain_file"] = _newest("category", _CHAIN_QUALITY + " end", "file_listing")
    sql["newest_chain_file_loose"] = _newest("category", _CHAIN_QUALITY + " when low like '%.csv' then 4 end", "file_listing")
    sql["newest_panel_file"] = _newest("", _PANEL_QUALITY, "panel_listing")
    sql["newest_panel_file_loose"] = _newest("", _PANEL_LOOSE, "panel_listing")

    sql["files_for_run_day"] = f"""select category, date '1998-03-01' as period, path, case when path is null then 'missing' else 'found' end as outcome
      from (values ('YERBA'), ('VAPES'), ('PANALES'), ('CIGARRILLOS')) w(category)
      left join (select category, path from ({sql['newest_chain_file_loose']}) where period = date '1998-03-01') using (category)"""

    context = 'category, fecha, id_sucursal, "codigo de barras"'
    sql["bad_numeric_rows"] = f"with {ctes('chain_feed')} " + " union all ".join(
        f"""select {context}, {strip(_col(c))} as bad_value, '{label}' as "column" from chain_feed where {bad_number(_col(c))}"""
        for c, label in (("unidades vendidas", "units"), ("total facturado", "amount"))
    )
    sql["top_bad_values"] = f"""with {ctes('chain_feed')} select {strip('"unidades vendidas"')} as bad_value, count(*) as n from chain_feed
      where {bad_number('"unidades vendidas"')} group by all order by n desc, bad_value limit 20"""
    sql["value_frequencies"] = f'with {ctes("queue")} select "Para Escritura", count(*) as n from queue group by all'
    sql["numeric_profile"] = _profile("")
    sql["numeric_profile_fine"] = """with v as (select cast(l_extendedprice * l_discount * l_tax as double) as x from lineitem)
      select count(*) as n, round(avg(x), 6) as mean, round(stddev_samp(x), 6) as std, round(min(x), 6) as min,
        round(quantile_cont(x, 0.25), 6) as q25, round(quantile_cont(x, 0.5), 6) as q50, round(quantile_cont(x, 0.75), 6) as q75,
        round(max(x), 6) as max from v where x is not null"""
    stores = "(select * from supplier where s_suppkey % 9 <> 4)"
    sql["validated_join_mixed_types"] = f"""with line as (select cast(l_suppkey as hugeint) as k, cast(l_linenumber as integer) as line from lineitem)
      select 'zeros' as kind, '00' || k as store, line, s_name from line left join {stores} on k = s_suppkey
      union all select 'digits', k || case when line % 2 = 0 then '.000' else '.00000000001' end, line, s_name
      from line left join {stores} on k = s_suppkey and line % 2 = 0
      union all select 'double', cast(k + {WIDE_DOUBLE} as varchar), line, s_name
      from line left join {stores} on k = s_suppkey and s_suppkey % 2 = 0
      union all select 'wide', cast(k + {WIDE_LONG}::hugeint as varchar), line, s_name from line left join {stores} on k = s_suppkey"""
    sql["numeric_profile_by_category"] = _profile("kind")
    return sql
